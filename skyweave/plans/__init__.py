"""Whole jobs: settings of the shipped catalogs and the steps that build them."""
