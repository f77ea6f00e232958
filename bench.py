"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   directory of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lockgate.session import local_session  # noqa: E402
from workload import registry  # noqa: E402

HEADLINE = [
    "q_one_pass", "q_count_check", "q_checksums", "q_partition_check", "q_sampled_hash", "q_fingerprint",
    "q_row_diff", "q_row_diff_drill", "q_multiset_diff", "q_multiset_diff_drill", "q_schema_diff",
    "q_copy_parquet", "q_copy_orc", "q_copy_csv", "q_convert", "q_compact", "q_profile_inventory",
    "q_compat_rules", "q_name_mapping", "q_worklist", "q_view_rewrite", "q_grant_map", "q_grants_missing",
    "q_rollback_plan", "q_active_parties", "q_latest_order", "q_open_exposure", "q_price_band",
    "q_synth_clientes_pf", "q_synth_transacoes", "q_synth_score_historico", "q_vw_score_atual",
    "q_vw_inadimplentes_ativos", "q_migration_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("lockgate-bench", os.environ.get("BENCH_CPUS", "8"), **{"spark.log.level": "OFF"})
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
