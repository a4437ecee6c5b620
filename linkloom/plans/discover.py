"""The whole way from responses to new addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from linkloom.operators.dedupe import capped, unknown
from linkloom.operators.extract import extract_candidates, seen_links
from linkloom.operators.nodes import placeholder_nodes
from linkloom.operators.quarantine import fine
from linkloom.operators.targets import targets
from linkloom.options import Options


class Metrics:
    """What a run has looked through and found, counted on the way. Once it has run: n_pages, n_bytes, n_candidates."""

    def __init__(self):
        self.pages, self.links = Observation(), Observation()

    @property
    def get(self) -> dict[str, int]:
        return self.pages.get | self.links.get


def found_targets(responses: DataFrame, options: Options, in_scope: Column | None = None, metrics: Metrics | None = None) -> DataFrame:
    found = extract_candidates(fine(responses, in_scope), options.parse_javascript, counter=metrics and metrics.pages)
    return targets(seen_links(found, metrics and metrics.links), options.discover_subdomains)


def discover(responses: DataFrame, site_nodes: DataFrame | None = None, options: Options | None = None, in_scope: Column | None = None, metrics: Metrics | None = None) -> DataFrame:
    """New addresses as nodes. site_nodes: what is known (session_id, uri). What can't be looked through is in quarantine.held()."""
    options = options or Options()
    found = found_targets(responses, options, in_scope, metrics)
    return placeholder_nodes(capped(found if site_nodes is None else unknown(found, site_nodes), options.most_inserts))
