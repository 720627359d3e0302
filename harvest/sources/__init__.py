"""Readers and writers: landed pages, snapshot tables, exports, the query matrix."""
