"""Writers and housekeeping: Parquet snapshots, text lists, TSV, retention."""

from coclick.sinks.files import (complete_snapshots, convert_if_absent, if_missing, is_complete, keep_latest, observed,
                                 save_model, write_clustered, write_lines, write_parquet, write_partition, write_snapshot, write_tsv)

__all__ = ["complete_snapshots", "convert_if_absent", "if_missing", "is_complete", "keep_latest", "observed", "save_model",
           "write_clustered", "write_lines", "write_parquet", "write_partition", "write_snapshot", "write_tsv"]
