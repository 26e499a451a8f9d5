from deskrisk.operators.latest import latest_per_key, latest_value  # noqa: F401
from deskrisk.operators.ranking import rank_rows  # noqa: F401
from deskrisk.operators.scratch import scratch_of_run, settle, together  # noqa: F401
from deskrisk.operators.upsert import merge_frames, merge_into, schema_guard  # noqa: F401
