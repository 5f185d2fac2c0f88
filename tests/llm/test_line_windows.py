"""Three-line windows against a direct computation."""

from pyspark.sql import functions as F

from fieldlens.llm.line_windows import dedup_lines


def brute(rows):
    seen, out = set(), {}
    for i, key, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        lines = text.split("\n") if text is not None else []
        gone = set()
        for k in range(len(lines) - 2):
            w = tuple(x.strip(" ") for x in lines[k:k + 3])
            if not any(w):
                continue
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        out[(i, key)] = (None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


def compare(df):
    rows = [(r.doc_id, r.k, r.text) for r in df.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"), "text").collect()]
    want = brute(rows)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in dedup_lines(df).collect()), key=str)
    assert got == sorted(((i, *want[(i, k)]) for i, k, _ in rows), key=str)
    return got


def test_by_definition(make, crowd):
    texts = ["\n".join(t[k:k + 9] for k in range(0, len(t), 9)) for t in crowd]
    assert sum(r[3] for r in compare(make(texts))) > 50


def test_overlapping_blank_and_odd(make, odd):
    compare(make(odd + [(20, "a\nb\nc\nd\na\nb\nc\nd\ne"), (21, "a\na\na\na\na"), (22, "\n\n\n\n"), (23, "b\nc\nd"), (20, "b\nc\nd")]))


def test_empty_and_clashing_columns(make, empty):
    assert dedup_lines(empty).count() == 0
    df = make(["x\ny\nz", "x\ny\nz"]).withColumns({c: F.lit(1) for c in ("line", "key", "cut_id", "lines", "first")})
    assert [r.text for r in dedup_lines(df).orderBy("doc_id").collect()] == ["x\ny\nz", ""]
