"""Analytics over collected job postings, on Spark DataFrames and Structured Streaming."""

from vacantia.operators.chars import apply_decisions, normalise_text, unclassified_chars
from vacantia.operators.dedupe import first_seen, only_new
from vacantia.operators.heat import (
    aged_sites, heat_range, selected_heat, site_counts, site_index, site_list, week_counts,
)
from vacantia.operators.html_nodes import html_nodes
from vacantia.operators.listings import explode_listings
from vacantia.operators.outcomes import outcomes
from vacantia.plans import (
    PLANS, flatten_companies, normalise_amazon, normalise_apple, normalise_dice, normalise_facebook,
    normalise_indeed,
)
from vacantia.session import build_session
from vacantia.sources.landed import read_raw
from vacantia.sources.sinks import export_csv
from vacantia.sources.stored import read_chars, read_postings, read_seen, read_sites
from vacantia.streaming.ingest import compact_seen, ingest
from vacantia.streaming.weekly import compact_days

__all__ = [
    "PLANS", "aged_sites", "apply_decisions", "build_session", "compact_days", "compact_seen", "explode_listings", "export_csv",
    "first_seen", "flatten_companies", "heat_range", "html_nodes", "ingest", "normalise_amazon",
    "normalise_apple", "normalise_dice", "normalise_facebook", "normalise_indeed",
    "normalise_text", "only_new", "outcomes", "read_chars", "read_postings", "read_raw",
    "read_seen", "read_sites", "selected_heat", "site_counts", "site_index", "site_list",
    "unclassified_chars", "week_counts",
]
