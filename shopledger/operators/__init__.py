from shopledger.operators.fingerprint import checksums, fingerprint, same_rows
from shopledger.operators.incremental import changed_since, extract_manifest, extract_summary
from shopledger.operators.latest import latest_by_key, upsert_by_key
from shopledger.operators.paging import ordered_page, seek_page
from shopledger.operators.skew import SkewPolicy, hot_keys, input_bytes, skew_join

__all__ = [
    "SkewPolicy",
    "changed_since",
    "checksums",
    "extract_manifest",
    "extract_summary",
    "fingerprint",
    "hot_keys",
    "input_bytes",
    "latest_by_key",
    "ordered_page",
    "same_rows",
    "seek_page",
    "skew_join",
    "upsert_by_key",
]
