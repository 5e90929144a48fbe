"""tidewater: Spark-native delivery of log events to analytics tables.

Every public operator is a plain ``DataFrame -> DataFrame`` (or column
expression) function so that it composes with ``df.transform``; the work
runs inside Spark's planner and executors, never on the driver.
"""

import sys

from pyspark import cloudpickle

from tidewater.functions.text import py_strip, is_blank
from tidewater.functions.cleaning import (
    C1_DROP_MV,
    C2_DROP_EMPTY,
    C3_DROP_EMPTY_MV,
    C4_DROP_RAW,
    C5_ALL,
    clean_column,
)
from tidewater.operators.clean import (
    clean_events,
    clean_json_events,
    drop_blank_lines,
    drop_empty_fields,
    drop_empty_mv_fields,
    drop_mv_fields,
    drop_raw_field,
)
from tidewater.operators.parse import apply_mapping, infer_rows, parse_raw, route_failures
from tidewater.operators.batch import (
    assign_byte_batch,
    assign_count_batch,
    assign_greedy_batch,
    assign_time_batch,
    new_run_id,
    order_chunk,
    tag_run,
)
from tidewater.operators.encode import encode_csv_line, encode_json
from tidewater.operators.account import SearchProgress, delivery_summary, search_funnel
from tidewater.operators.lifecycle import (
    alert_events,
    alert_windows,
    expired,
    expired_files,
    retain,
    sweep_expired,
)
from tidewater.sources.search import explode_results, search_head
from tidewater.sources.files import (
    eligible_files,
    is_eligible,
    list_files,
    read_raw_lines,
    read_staged_csv,
    read_staged_json,
    unchanged_files,
    walk_files,
)
from tidewater.sinks.tables import append_table, deliver_direct, stage_csv, stage_json
from tidewater.streaming.load import attempts, committed_rows, dead_letters, load_ledger, load_staged
from tidewater.streaming.intake import stage_intake
from tidewater.streaming.stage import stage_stream
from tidewater.streaming.alerts import FiringWindows, alert_windows_stream
from tidewater.sinks.tables import append_routed
from tidewater.operators.parse import route_label
from tidewater.plans.programs import alert_action, backfill, forwarder, run_alert

__all__ = [name for name in dir() if not name.startswith("_")]

# Functions that run in Python workers travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
