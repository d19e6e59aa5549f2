"""Training-data operators (quality, dedupe, decontamination, PII, packing, ...).

Nothing outside this subpackage imports it.
"""
