"""

    from marquee import api as mq
    games = mq.surrogate_key(stg, "appid", "game_key")
"""

from .functions.cleaning import (blank_to_null, clean_name, clean_number, decimal_comma,  # noqa: F401
                                 gain, int_half_even, int_half_up, int_trunc, link_id,
                                 name_part, percent, suffix_number)
from .functions.dates import (month_floor, parse_any_date, parse_day, parse_timestamp,  # noqa: F401
                              relative_month)
from .operators.declared import (LEGACY_TABLES, constraint_report, declared_load,  # noqa: F401
                                 declared_write, enforce, fit, read_declared)
from .operators.filters import match_by_name, unreleased  # noqa: F401
from .operators.keys import get_or_create_keys, surrogate_key  # noqa: F401
from .operators.loads import (accept_metrics, first_per_key, fk_split, insert_audit,  # noqa: F401
                              insert_ignore, load_audit, status_log)
from .operators.members import bridge, distinct_members, member_links  # noqa: F401
from .operators.paging import (keyset_page, last_block, next_cursor, page, pending,  # noqa: F401
                               range_shard, shard, union_blocks)
from .operators.quality import (check_not_null, check_relationship, check_unique,  # noqa: F401
                                run_checks, warehouse_checks)
from .plans.goals import member_month, price_viewer_corr  # noqa: F401
from .plans.marts import build_warehouse, dim_date as date_dim, dim_entity, fact  # noqa: F401
from .plans.staging import stage_catalogue, stage_metrics  # noqa: F401
from .sources.files import (drop_last_per_group, read_catalogue_json, read_catalogue_variant,  # noqa: F401
                            read_keyed_csv, read_metrics_csv, read_semicolon_csv)
from .sources.pages import drop_notice_pages, extract_links, extract_tables  # noqa: F401
from .sources.payload import parse_payload, payload_rejects  # noqa: F401
from .sources.publish import Publication, expire, manifest, published, versions  # noqa: F401
from .sources.sinks import export_batches, export_csv, export_json, write_bucketed, write_table  # noqa: F401
from .sources.tables import scan_table  # noqa: F401
from .streaming.incremental import run_incremental  # noqa: F401
