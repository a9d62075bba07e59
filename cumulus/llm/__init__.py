"""Training-data operators: quality, de-duplication, mixing, packing, scans.

Each operator has a module of its own with a general interface;
``queries`` binds them to the test tables. Nothing outside this
subpackage imports it.
"""
