"""Training-data operators: language id, dedup, decontamination, packing, ...

Nothing else in the package imports this subpackage.
"""
