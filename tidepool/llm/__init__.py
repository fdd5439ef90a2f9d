"""Training-data operators: language ID, quality rules, packing, token files,
near and exact de-duplication, web archives, model scoring, mixing and secret
scans.  Nothing outside this subpackage imports it."""
