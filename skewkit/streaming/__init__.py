"""Structured Streaming jobs: stateful counts, offset ledger, co-committed writes."""

from skewkit.streaming.apps import (  # noqa: F401
    start_running_counts, start_running_counts_in_state, start_running_counts_per_record, start_running_counts_with_state,
    start_sales_table, start_sales_upsert, start_window_count_deltas, start_window_counts, start_word_count_table,
    start_word_count_with_offsets,
)
from skewkit.streaming.jobs import (  # noqa: F401
    SalesUpsertCommit, WindowCountCommit, WordCountCommit, batch_word_count, read_window_counts,
    replay_in_chunks, word_counts_with_ledger,
)
from skewkit.streaming.ledger import (  # noqa: F401
    cocommit_batch, latest_ledger, offset_ledger, read_accumulated, read_latest, read_ledger,
    resume_from_ledger,
)
from skewkit.streaming.keyed_state import read_state_counts, running_count_with_state  # noqa: F401
from skewkit.streaming.running import RunningCountCommit, running_totals  # noqa: F401
from skewkit.streaming.stateful import (  # noqa: F401
    UpdateLog, latest_updates, running_count, running_count_per_record,
    running_count_per_record_batch, tumbling_count,
)
from skewkit.streaming.tables import (  # noqa: F401
    CountTableCommit, FencedWriter, KeyedTable, SalesTableCommit, count_table, sales_table,
)
