from __future__ import annotations

import re
import textwrap

import duckdb

from tidemark.llm import quality, queries
from tidemark.llm.oracles import ORACLES

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    held = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + 8)} if len(runs) < 500 else None
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), held and len(held)


def test_odd_rows(spark, documents_of, odd_rows):
    got = quality.judged(documents_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    wanted = sorted((repr(i), base(t or "")) for i, t in odd_rows)
    figures = sorted((repr(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)
    for (i, w), (j, g) in zip(wanted, figures, strict=True):
        assert i == j and w[:4] == g[:4] and (w[4] is None or (w[4] or 0) == g[4])
    kept = {r.doc_id: r.kept for r in got}
    assert kept[1] and kept[2] and kept[9] and not kept[4] and not kept[5] and not kept[7] and not kept[11]


def test_repeated_runs(spark, documents_of):
    text = " ".join(f"w{i}" for i in range(30)) + " " + " ".join(f"w{i}" for i in range(5, 20)) + " end."
    (row,) = quality.judged(documents_of([(1, text)])).collect()
    assert row.n_repeat_words == 30 == base(text)[4]


def test_line_rules(spark, documents_of):
    good = "This line has a full sentence and it stays."
    bad = ["Home | News | Sport | About", "We use cookies on this site.", "no sentence end here", "a### b$$$ c%%%."]
    rows = [(1, "\n".join([good] * 8 + bad)), (2, "\n".join(["Home | News | Sport | About | More"] * 9 + [good]))]
    got = {r.doc_id: r for r in quality.judged(documents_of(rows)).collect()}
    assert got[1].kept_text.split("\n") == [good] * 8
    assert got[2].kept_text == good and not got[2].kept


def test_cleaned_keeps_columns(spark, documents_of, odd_rows):
    docs = documents_of(odd_rows)
    out = quality.cleaned(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    rows = out.collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 9, None}
    assert all(r.n_chars == len(r.text) and r["a.b"] == f"a.b{r.doc_id}" for r in rows)
    assert quality.cleaned(documents_of([])).count() == 0


def test_wrapped_prose_stays(spark, documents_of):
    docs = {r.doc_id: r for r in quality.judged(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()}
    clean = {i: r.kept_text for i, r in docs.items() if r.kept and 2 * r.n_kept_words > r.n_words}

    def wrapped(text, width):
        return "\n".join("\n".join(textwrap.wrap(x, width, break_long_words=False, break_on_hyphens=False)) for x in text.split("\n"))

    for width in (72, 60):
        rows = [(i, wrapped(t, width)) for i, t in clean.items()]
        got = quality.judged(documents_of(rows)).collect()
        assert len(got) > 50 and all(r.kept or r.base_failed for r in got)
        assert sum(r.n_kept_words for r in got) > 0.99 * sum(r.n_words for r in got)


def test_other_scripts_stay(spark, documents_of):
    hindi = "नदी के किनारे एक पुराना गाँव बसा हुआ था।\nवहाँ के लोग खेती करते थे और शाम को गीत गाते थे।\nबारिश आने पर सब बच्चे आँगन में खेलने लगते हैं।"
    thai = "\n".join(f"ข้อความนี้เป็นประโยคภาษาไทยที่ {i} และควรอยู่ในเอกสาร ต่อไปอีก นาน {i}" for i in range(9))
    junk = ["Home News Sport About Contact Login", "https://example.org/" + "a1" * 40, "buy buy buy buy buy buy now now now", "no end here"]
    good = "This line has a full sentence and it stays where it is."
    got = {r.doc_id: r for r in quality.judged(documents_of([(1, hindi), (2, thai), (3, "\n".join([good] + junk))])).collect()}
    assert got[1].kept_text == hindi and got[2].kept_text == thai and got[3].kept_text == good
    assert got[1].kept and got[2].kept


def test_sql_states_the_same_rules(spark, tmp_path):
    """Wrapped texts, other scripts, menus, capitals and notices of all lengths, in the code and in DuckDB."""
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, "\n".join(textwrap.wrap(t or "", 40))) for i, t in docs[:60]] + [(1000 + i, t) for i, t in docs[60:90]]
    words = "one more word that stands in the line here and there with nothing else to say"
    odd = [f"{words} {notice}{' ' + words if k % 2 else ''}" * (1 + k % 7) for k, notice in enumerate(quality.NOTICES)]
    odd += ["यह एक पूरा वाक्य है जो यहाँ खड़ा है।", "นี่คือประโยคยาวที่ไม่มีช่องว่างเลย", "这是一个没有空格的句子", "Home About Contact News Sport", "the the the the the the", "Ünder Éinem Öl Ägypten Straße"]
    rows += [(2000 + i, "\n".join([x] * 2 + [words + "."] * 3)) for i, x in enumerate(odd)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op2_quality(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(ORACLES["op2_quality"])
    names = [d[0] for d in result.description]
    want = {r[names.index("doc_id")]: dict(zip(names, r, strict=True)) for r in result.fetchall()}
    got = {r.doc_id: r.asDict() for r in found.collect()}
    assert got == {i: {c: want[i][c] for c in got[i]} for i in want}
    kept = [r["n_kept_words"] for r in got.values()]
    assert len(set(kept)) > 20


def test_a_notice_fails_a_line_by_its_share(spark, documents_of):
    long = "we use cookies " + "and then there is much more that this line has to say about them " * 8 + "."
    rows = [(1, "We use cookies here, so be it.\n" + "This line is a good one, and it stays. " * 9), (2, long)]
    got = {r.doc_id: r.kept_text for r in quality.judged(documents_of(rows)).collect()}
    assert "cookies" not in got[1] and got[2] == long


def test_a_text_of_a_million_characters(spark, documents_of):
    rows = [(1, "x" * 1_000_000), (2, "A good sentence of some words stands here. " * 23_000)]
    got = {r.doc_id: r.n_words for r in quality.judged(documents_of(rows)).collect()}
    assert got == {1: 1, 2: 8 * 23_000}
