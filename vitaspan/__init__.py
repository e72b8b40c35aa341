"""PySpark operators that turn event tables about subjects into one cohort table and analyse time to event."""

from vitaspan.functions.scalars import (any_of, bucket, capture, decode_age, is_capped, join_parts, level_index, levels,
                                        null_if, number_text, paste, recode, remove_first, split_head_rest, to_number)
from vitaspan.operators.cox import cox, cox_models, cox_univariable, level_counts
from vitaspan.operators.frames import (across, add_after, cols_between, cols_like, distinct_sorted, label,
                                       null_if_all_strings, relocate)
from vitaspan.operators.joins import (assemble, assert_unique, duplicates, join_ns, member_update, pair_lookup,
                                      semi_by_list, tagged_union, tiered_union_first, union_fill)
from vitaspan.operators.ordered import (closest_per_key, dense_rank_nulls_out, fill, first_per_key, group_any,
                                        group_first, group_min, group_size, group_values, last_per_key, scan, sequence_no,
                                        spread_flag, strongest_per_key, top_per_key)
from vitaspan.operators.reshape import (collect_ordered, concat_ordered, pivot_blocks, pivot_ordinal, pivot_wide,
                                        unpivot_long)
from vitaspan.operators.scan import quantiles, running
from vitaspan.operators.survival import kaplan_meier, logrank, logrank_counts, median_survival, risk_table
from vitaspan.operators.tables import (box_outliers, box_stats, by_frequency, frequency, group_tests, header_counts,
                                       histogram, merge_tables, rank_sums, summary_table)
from vitaspan.plans.endpoints import endpoint
from vitaspan.plans.timeline import first_of, last_contact, line_of_therapy, regimens
from vitaspan.session import drop_frozen, freeze, prepare
from vitaspan.sources.readers import read_delim, read_family, read_table
from vitaspan.sources.writers import write_table

__all__ = [name for name in dir() if not name.startswith("_")]
