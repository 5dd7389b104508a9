from .dedupe import collapse, dedupe_first, dedupe_last, dedupe_latest, distinct_keys
from .filters import Hop, filter_active, filter_by_parent, in_scope, not_existing, require_all
from .in_order import merge_in_order, writes_in_order
from .lookup import (
    key_map, link_parent, lookup_chain, lookup_key, lookup_required, map_codes, match_any_key,
    remap_cascade, unmapped,
)
from .merge import guarded_merge, insert_only, match_source, merge, merge_with_actions
from .quality import (
    REJECT, cast_to_spec, fk_violations, load_summary, reject_first, reject_if, reject_report,
    report_sample, split_rejects, unique_violations, validate,
)
from .reshape import explode_groups, fan_out, multi_emit, project_map, sorted_projection, unpivot_fields
from .resolve import resolve_entity, resolve_within
from .rules import Rule, route_rules
from .unique import assign_unique

__all__ = [
    "Hop", "REJECT", "Rule", "assign_unique", "cast_to_spec", "collapse", "dedupe_first",
    "dedupe_last", "dedupe_latest", "distinct_keys", "explode_groups", "fan_out", "filter_active",
    "filter_by_parent", "fk_violations", "guarded_merge", "in_scope", "insert_only", "key_map",
    "link_parent", "load_summary", "lookup_chain", "lookup_key", "lookup_required", "map_codes",
    "match_any_key", "match_source", "merge", "merge_with_actions", "multi_emit", "not_existing",
    "project_map", "reject_first", "reject_if", "reject_report", "remap_cascade", "report_sample", "require_all", "resolve_entity",
    "resolve_within", "route_rules", "sorted_projection", "split_rejects", "unique_violations",
    "unmapped", "unpivot_fields", "validate",
]
