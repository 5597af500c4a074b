"""Operators for training corpora: scoring, de-duplication, mixing, packing, scanning.

Each module holds one operator with a general interface; `registry` lists the queries that
apply them to whole tables. Nothing else in the library imports this subpackage.
"""
