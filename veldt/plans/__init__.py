"""Registered queries: one module per family, collected by ``registry``."""
