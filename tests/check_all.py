"""Run registered queries at one scale and print time and verdict: check_all.py <sf_dir> [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, connect  # noqa: E402

from corpusloom.queries import all_queries  # noqa: E402
from corpusloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", 8, **{"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name, q in all_queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            if q.sql:
                verdict = compare(spark, con, sf_dir, q.build, q.sql) or "ok"
            else:
                verdict = f"{q.build(spark, sf_dir).count()} rows"
        except Exception as exc:  # noqa: BLE001
            verdict = f"ERROR {type(exc).__name__}: {str(exc)[-700:]}"
        print(f"{name:24s} {time.time() - t:6.1f}s  {verdict}", flush=True)
