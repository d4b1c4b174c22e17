"""Columns and driver-side helpers: matchers, line filters, time bounds, regular expressions."""
