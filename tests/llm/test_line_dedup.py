from collections import defaultdict

from pyspark.sql import functions as F

from enrolmeter.llm.line_dedup import LineRuns, dedup_lines

SPACES = " \t\n\x0b\f\r"
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, limit=3, least=20):
    key = lambda line: line.strip(SPACES).translate(FOLD)
    held = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                held[key(line)].add(i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(held[key(x)]) < limit or max(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted(map(tuple, rows), key=repr)


def test_awkward_rows(documents, awkward):
    boiler, other = "This line is long enough, ÉTÉ.", "Another line that repeats itself."
    rows = awkward + [
        (20, f"{boiler}\nfirst\n{boiler}"), (21, f" {boiler.replace('T', 't')}\t\nsecond"),
        (22, f"\n\n{boiler}\n"), (23, f"{other}\n{boiler.lower()}"), (24, other), (24, other), (None, other),
        (25, "short\nshort"), (26, f"{other} "), (27, f"{boiler}\n{other}"), (27, f"{boiler}\n{other}"),
    ]
    df = dedup_lines(documents(rows))
    assert got(df) == brute(rows)
    assert {r["pos"] for r in df.select("pos").collect()} == {"x0"}


def test_documents_with_the_same_lines_in_every_batch(documents):
    rows = [(i, f"The common line number {i % 7} of many\nown line of document {i}") for i in range(80)]
    for batches in (1, 3, 9):
        assert got(dedup_lines(documents(rows, clashing=False), batches=batches, fanout=2)) == brute(rows)


def test_runs_are_sorted_compacted_and_leave_settled_hashes_out(spark, tmp_path):
    runs = LineRuns(spark, str(tmp_path), limit=2, fanout=2)
    batch = lambda rows: spark.createDataFrame(rows, "h1 long, h2 long, doc_id long")
    runs.add(batch([(1, 1, 90), (1, 1, 91), (2, 2, 90)]))
    runs.add(batch([(1, 1, 80), (2, 2, 80)]))  # hash 1 is settled: only hash 2 is stored
    assert [len(level) for level in runs.levels] == [0, 1]
    merged = sorted(tuple(r) for r in runs.merged().collect())
    assert merged == [(1, 1, 2, 91), (2, 2, 2, 90)]
    runs.add(batch([(1, 1, 95)]))  # a larger document is news
    assert runs.merged().where("h1 = 1").first()["last_doc"] == 95
    for level in runs.levels:
        for path in level:
            for part in spark.read.parquet(path).select(F.spark_partition_id().alias("p"), "h1").collect():
                assert part.h1 in (1, 2)
