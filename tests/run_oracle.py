"""Manual driver-like check: python tests/run_oracle.py [sf_dir] [name ...]"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from ferret.plans import catalog  # noqa: E402
from ferret.session import get_spark  # noqa: E402
from tests.oracle_harness import compare, duck  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(catalog.QUERIES)
spark = get_spark(8)
con = duck(sf)
ok = 0
for n in names:
    t = time.time()
    if n not in catalog.SQL:
        rows = catalog.QUERIES[n](spark, sf).count()
        print(f"{n:24s} rows-only {rows} ({time.time() - t:.1f}s)", flush=True)
        continue
    try:
        s, d, srows, drows, scols, dcols = compare(spark, catalog.QUERIES[n], catalog.oracle_text(n), sf, con)
    except Exception as e:  # noqa: BLE001
        print(f"{n:24s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
        continue
    good = s == d
    ok += good
    print(f"{n:24s} {'OK ' if good else 'BAD'} spark={s[0]} duck={d[0]} ({time.time() - t:.1f}s)", flush=True)
    if not good:
        print("   cols", s[1], d[1])
        ss = {tuple(map(str, r)) for r in srows}
        dd = {tuple(map(str, r)) for r in drows}
        print("   only spark:", sorted(ss - dd)[:3])
        print("   only duck :", sorted(dd - ss)[:3])
print(f"{ok}/{len([n for n in names if n in catalog.SQL])} SQL-checked OK")
