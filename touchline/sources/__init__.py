"""Scans, loaders and sinks."""

from touchline.sources.names import no_source_names, read_source_names
from touchline.sources.raw_visits import load_json_dump, normalize_raw_visits, read_raw_visits
from touchline.sources.sampling import user_bucket, user_sample
from touchline.sources.publish import publish, publish_table, read_published
from touchline.sources.sinks import (
    append_tsv, publish_chains, publish_visits, save_chains, save_visits, write_chains, write_report_tsv, write_visits,
)
from touchline.sources.tsv import read_tsv, write_tsv

__all__ = [
    "append_tsv", "load_json_dump", "no_source_names", "normalize_raw_visits", "publish", "publish_chains",
    "publish_table", "publish_visits", "read_published", "read_raw_visits", "read_source_names", "read_tsv",
    "save_chains", "save_visits", "user_bucket", "user_sample", "write_chains", "write_report_tsv", "write_tsv",
    "write_visits",
]
