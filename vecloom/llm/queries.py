"""All registered queries of this subpackage."""

from . import align, decontam, exact_dedup, langid, minhash, mixing, phrases, quality, secret_scan, sharding, suffix_dedup, urlfilter, warc  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
