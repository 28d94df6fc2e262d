from collections import Counter
from pathlib import Path

from tickloom.llm import lines
from tickloom.llm.queries import op6_line_dedup, table

SF = "/root/testdata/sf0.001"


def rolling(spark, docs):
    """Spark's rolling hash of every two neighbouring lines with text, by their texts and distance."""
    pairs = set()
    for _, text in docs:
        own = (text or "").split("\n")
        filled = [i for i, line in enumerate(own) if line.strip()]
        pairs |= {(own[a], own[b], b - a) for a, b in zip(filled, filled[1:])}
    df = spark.createDataFrame(sorted(pairs), "a string, b string, gap int")
    rows = df.selectExpr("a", "b", "gap", "xxhash64(xxhash64(a), xxhash64(b), gap) AS h").collect()
    return {(r.a, r.b, r.gap): r.h for r in rows}


def brute(spark, docs):
    """Chunks cut, grown and compared as texts in plain Python, in order of document and place."""
    hashes = rolling(spark, docs)
    cut = {}
    for doc, text in docs:
        if doc is None or text is None or doc in cut:
            continue
        own = text.split("\n")
        filled = [i for i, line in enumerate(own) if line.strip()]
        h = [
            hashes[own[a], own[b], b - a] if len(own[a].strip()) + len(own[b].strip()) >= lines.LEAST else None
            for a, b in zip(filled, filled[1:])
        ]
        cut[doc] = own, [
            (filled[k], filled[k + 1], filled[k - 1] if k else None, filled[k + 2] if k + 2 < len(filled) else None)
            for k in range(len(h)) if h[k] is not None and (
                len(own[filled[k]].strip()) + len(own[filled[k + 1]].strip()) >= lines.MOST
                or any(not 0 <= j < len(h) or h[j] is None or h[k] <= h[j] for j in (k - 1, k + 1)))
        ]
    first = {}
    for doc in sorted(cut):
        own, found = cut[doc]
        for c in found:
            first.setdefault("\n".join(own[c[0] : c[1] + 1]), (doc, c))
    gone = {doc: set() for doc in cut}
    for doc, (own, found) in cut.items():
        for s, e, b, a in found:
            at, (fs, fe, fb, fa) = first["\n".join(own[s : e + 1])]
            other = cut[at][0]
            if at == doc and s - fs <= e - s:
                continue
            gone[doc] |= set(range(s, e + 1))
            start = b if b is not None and fb is not None and own[b:s] == other[fb:fs] else s
            end = a if a is not None and fa is not None and own[e + 1 : a + 1] == other[fe + 1 : fa + 1] else e
            if at != doc or start - (fb if start == b else fs) > end - start:
                gone[doc] |= set(range(start, end + 1))
    out = []
    for doc, text in docs:
        cutout = gone.get(doc) if text is not None else None
        if cutout:
            own = text.split("\n")
            text = "\n".join(x for i, x in enumerate(own) if i not in cutout)
            out.append((doc, text, len(cutout)) if text.strip() else (doc, "", len(own)))
        else:
            out.append((doc, text, 0))
    return Counter(out)


def result(df):
    return Counter((r.doc_id, r.text, r.lines_removed) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = result(op6_line_dedup(spark, SF))
    assert got == brute(spark, docs)
    assert sum(n * v for (_, _, n), v in got.items()) > 0


def test_edge_cases(spark):
    passage = "\n".join(f"line {i} of the shared passage" for i in range(14))
    texts = [
        (1, "start\n" + passage + "\nend"), (2, "other\nthings\n" + passage), (3, passage), (3, passage), (4, None),
        (5, ""), (6, "one line"), (7, "one line"), (8, "\n" * 40), (9, "\n" * 40), (10, passage + "\n" + passage),
        (None, passage), (11, "a\nb " * 20_000), (12, "x\n\ny\n\n"), (13, "x\n\ny\n\n"), (14, "c\nc\nc\nc\nc"),
        (15, "a line that is long enough\n\n \nand another one after blanks\nmore"),
        (16, "first\na line that is long enough\n\n \nand another one after blanks\nmore"),
    ]
    df = spark.createDataFrame([(i, t, "x", 9) for i, t in texts], "doc_id long, text string, _spans string, lines_removed int")
    got = lines.dedup_lines(df)
    assert set(got.columns) == set(df.columns)
    assert result(got) == brute(spark, texts)
    assert {r._spans for r in got.collect()} == {"x"}
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_closing_brackets_stay(spark):
    rows = [(k, f"def number_{k}:\n  {{\n    call {k}\n    }}\n  }}\n}}\nlast line of {k}") for k in range(8)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == rows


def test_runs_of_three_lines_go_whole(spark):
    rows = []
    for n in range(2, 9):
        for k in range(20):
            run = [f"shared line {j} of run {k} with {n} lines" for j in range(n)]
            rows.append((100 * n + k, "\n".join([f"before {n} {k}", *run, f"after {n} {k}"])))
            rows.append((10_000 + 100 * n + k, "\n".join([f"head {n} {k}", f"more {n} {k}", *run, f"tail {n} {k}"])))
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    short = 0
    for doc, _ in rows:
        n, k = doc % 10_000 // 100, doc % 100
        if doc < 10_000:
            assert got[doc].lines_removed == 0
        elif n == 2:
            short += got[doc].lines_removed == 2
        else:
            assert got[doc].text == f"head {n} {k}\nmore {n} {k}\ntail {n} {k}"
    assert short >= 5


def test_two_long_lines_always_go(spark):
    rows = []
    for k in range(30):
        run = [f"a sentence of run {k} " * 7, f"another one of run {k} " * 7]
        rows.append((k, "\n".join([f"before {k}", *run, f"after {k}"])))
        rows.append((100 + k, "\n".join([f"head {k}", f"more {k}", *run, f"tail {k}"])))
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[100 + k].text == f"head {k}\nmore {k}\ntail {k}" for k in range(30))


def test_a_passage_is_cut_alike_wherever_it_stands(spark):
    passage = [f"sentence number {i} stands here" for i in range(60)]
    rows = [(k, "\n".join([*(f"own {k} {j}" for j in range(k % 7)), *passage, f"tail {k}"])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.lines_removed for r in lines.dedup_lines(df).collect()}
    assert left[0] == 0 and all(n == 60 for k, n in left.items() if k)
    own = lines.chunks(df, "doc_id", "text").where("_id IN (0, 3)").select("_id", "_hash").collect()
    assert len({r._hash for r in own if r._id == 0} & {r._hash for r in own if r._id == 3}) >= 28


def test_written_texts_of_chunks_are_deleted(spark):
    kept = Path(spark.conf.get("spark.checkpoint.dir"))
    passage = "\n".join(f"line {i} of the shared passage" for i in range(14))
    texts = [(k, f"start {k}\n{passage}\nend {k}") for k in range(6)]
    before = set(kept.glob("*"))
    got = lines.dedup_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {p.name.rsplit("-", 1)[0] for p in set(kept.glob("*")) - before} == {"lines-spans"}
    assert result(got) == result(got) == brute(spark, texts)
    assert sum(r.lines_removed for r in got.collect()) == 5 * 14


def test_no_python_in_the_plan(spark):
    plan = op6_line_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
