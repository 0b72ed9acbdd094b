"""Parameters of the registered test queries (one place, shared by the Spark
queries and their SQL oracles)."""

# Date of the daily jobs and the merge horizon (events cover 2024-01-01..30).
DAY = "2024-01-30"
MERGE_DAYS = 30
# Evaluation: predictions from days <= PRED_DAY, labels = local day PRED_DAY+1.
PRED_DAY = "2024-01-29"
LABEL_DAY = "2024-01-30"
TZ = 7
# Whitelist: parts with p_size <= 25.
WHITELIST_MAX_SIZE = 25
# Graph sampling: hop sizes and seed; merged edges need w > EDGE_THRE
# (the events graph is sparse, so the reference default 3 is lowered to 1).
HOP1 = 10
HOP2 = 10
EDGE_THRE = 1
SEED = "coclick"
# kNN / vectors
KNN_K = 10
N_LISTS = 16
N_PROBE = 12          # recall@10 0.916 at sf0.01, 0.926 at sf0.1
N_PROBE_WIDE = 13     # 0.945 and 0.953
BATCH_SIZE = 32
EVENTS_MIN_WEIGHT = 3
MMR_K = 20
MMR_TOP_N = 10
