"""Scans: driver tables, persons exports, mail files, block lists, directories."""
