"""Mixing: targets against filling by hand, copies against the definition."""

import math
from collections import defaultdict
from hashlib import md5

from pyspark.sql import functions as F

from fieldlens.llm.mixture import mixed, source_targets, systematic_copies


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not full:
            target.update({s: level * w[s] for s in open_})
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets(spark):
    for sizes in ({"a": 100, "b": 900, "c": 50, None: 30}, {"a": 5}, {"a": 0, "b": 10, "c": 0}, {"a": 0, None: 0},
                  {f"s{k:02}": (k * 37) % 101 for k in range(40)}):
        got = source_targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")).collect()
        want = targets_by_hand(sizes)
        assert {r.source for r in got} == set(sizes)
        for r in got:
            assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9), (sizes, r)


def test_copies_by_definition(make, crowd):
    df = make(crowd)
    rows = systematic_copies(df).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.mix_source].append(r)
    for source, group in by.items():
        group.sort(key=lambda r: (r["size"], r.digest, r.doc_id))
        assert sum(r["size"] for r in group) == group[0].source_size
        rate = group[0].target / group[0].source_size
        shift = int(md5(f"offset:{source}".encode()).hexdigest()[:8], 16) / 2 ** 32
        running = 0.0
        for k, r in enumerate(group, 1):
            assert r.copies == math.floor(k * rate + shift) - math.floor((k - 1) * rate + shift) <= 2
            running += r.copies * r["size"]
        assert abs(running - group[0].target) <= 2 * max(r["size"] for r in group)


def test_reruns_and_partitions_agree(make, crowd):
    key = lambda df: sorted((r.doc_id, r.copies) for r in systematic_copies(df).collect())
    assert key(make(crowd, 1)) == key(make(crowd, 7))


def test_odd_rows(make, odd, empty, spark):
    df = make(odd).withColumn("source", F.when(F.col("doc_id") < 5, F.lit("a"))).withColumns(
        {c: F.lit(1) for c in ("size", "copies", "mix_key", "target")})
    rows = systematic_copies(df).collect()
    assert len(rows) == len(odd) and {r.mix_source for r in rows} == {"a", None}
    out = mixed(df)
    assert out.columns == [*df.columns, "copy_no"]
    assert out.count() == sum(r.copies for r in rows)
    assert systematic_copies(empty).count() == 0 and mixed(empty).count() == 0
