"""DataFrame operators; all take column names and an explicit ``as_of`` where dates matter."""

from episodica.operators.flags import flag_bits, flags_in_one_pass, flags_of_ids, with_flags
from episodica.operators.identity import members_of, merge_ids
from episodica.operators.latest import best_again, best_of, latest_by
from episodica.operators.ordering import with_order_key
from episodica.operators.prune import IdFilter, in_ranges, key_ranges
from episodica.operators.snapshot import builds, write_snapshot
from episodica.operators.star import lookup, with_child
from episodica.operators.summary import attach, attach_first_so_far, earliest, earliest_again

__all__ = [
    "IdFilter",
    "attach",
    "attach_first_so_far",
    "best_again",
    "best_of",
    "builds",
    "earliest",
    "earliest_again",
    "flag_bits",
    "flags_in_one_pass",
    "flags_of_ids",
    "in_ranges",
    "key_ranges",
    "latest_by",
    "lookup",
    "members_of",
    "merge_ids",
    "with_child",
    "with_flags",
    "with_order_key",
    "write_snapshot",
]
