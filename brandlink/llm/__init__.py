"""Operators for large-scale training-data pipelines (LM scoring, tokenising,
deduplication, filtering, mixing).  Nothing else in the library imports this
package; its queries are in :mod:`.queries`, their SQL in :mod:`.oracle`."""
