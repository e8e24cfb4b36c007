from fieldops.sources.tables import (  # noqa: F401
    TABLES, read_table, register_views, read_seed, seed_frame, read_text_table,
    write_table, as_view, with_audit,
)
from fieldops.sources.snapshots import read_snapshots, latest_snapshot  # noqa: F401
