import hashlib

import pytest

from returns_analytics.llm import fim

TEXTS = ["", None, "a", "é🙂東京 naïve", "x<P>y", "x<S>", "<M>", "<P", "a<b>c<S <M", "<<P", "line\n" * 50, "long 🙂 text " * 3000, "  "]


def brute(doc_id, text):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:p], text[p:q], text[q:]
    if h4 % 100 < 20:
        return n, "spm", p, q - p, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", p, q - p, f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rows = [(i, TEXTS[i % len(TEXTS)], "x", 0) for i in range(260)]
    return rows + [rows[3], rows[3], (None, "no id at all", "x", 0), (None, None, "x", 0), (4, "other text, same id", "x", 0)] + [(7, "hot", "x", 0)] * 100


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, place int").repartition(5)


@pytest.mark.parametrize("unit", [1, 7, 4096])
def test_outputs(frame, rows, unit):
    if unit == 1:
        frame, rows = frame.filter("text is null or length(text) < 100"), [r for r in rows if len(r[1] or "") < 100]
    got = sorted(map(str, map(tuple, fim.transform(frame, unit).collect())))
    assert got == sorted(str((i, *brute(i, t))) for i, t, *_ in rows)
    got = sorted(map(str, map(tuple, fim.digest(frame, unit).collect())))
    assert got == sorted(str((i, *brute(i, t)[:4], sha(brute(i, t)[4]), sha(t))) for i, t, *_ in rows)


def test_restored_from_output_and_form(rows):
    forms = set()
    for i, text, *_ in rows:
        _, form, _, _, output = brute(i, text)
        forms.add(form)
        assert fim.restore_text(output, form) == (text or "")
    assert forms == {"plain", "psm", "spm"}


def test_pieces_are_bounded_and_dealt_once(frame):
    pieces = fim.pieces(frame, 10)
    assert max(len(r.piece.decode()) for r in pieces.select("piece").collect()) <= 10
    plan = fim.digest(frame)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("hashpartitioning") == 1  # the sort for the restoration needs no exchange


def test_restoration_sees_a_changed_output(spark):
    """The restored digest comes from the pieces of the output, not from the text."""
    frame = spark.createDataFrame([(1, "some text to cut into pieces")], "doc_id long, text string")
    assert fim.cut_points(1, 28)[0] != "plain"
    ddl, restored = fim._ddl(fim._SECTIONS), fim._ddl(fim._DIGEST)
    from pyspark.sql import functions as F

    changed = fim.pieces(frame, 5).withColumn("piece", F.expr("case when place = 1 then encode('XX', 'UTF-8') else piece end"))
    row = changed.mapInArrow(fim._sections, ddl).sortWithinPartitions("doc_id", "content", "row", "section", "place").mapInArrow(fim._restored, restored).first()
    assert row.restored_sha256 != sha("some text to cut into pieces")


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digest(empty).count() == 0 and fim.transform(empty).count() == 0
