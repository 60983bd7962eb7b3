"""Named queries of the library with their SQL counterparts."""

from . import deid_queries, matcher_queries, pairing_queries, segment_queries, signal_queries, trigger_queries

_PARTS = (trigger_queries, segment_queries, matcher_queries, pairing_queries, signal_queries, deid_queries)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLE = {k: v for part in _PARTS for k, v in part.ORACLE.items()}


def flagship(spark, sf_dir):
    """Pulses of every recording with code, time, and interval."""
    return QUERIES["trigger_intervals"](spark, sf_dir)
