"""Fill-in-the-middle: the piece table, awkward rows, and brute force on the small table."""

import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from txmill.llm import fim, queries

SCHEMA = "doc_id bigint, text string, n bigint, form string, output string, fim string, extra int"
TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
TEXTS = [
    "one two  three\nfour",
    "  leading and trailing \t",
    "",
    None,
    " ",
    "é 😀 x y z\x1cw",
    "has <S> inside",
    "broken <S <P> or <M",
    "almost <S <P <M >",
    "a",
    "word " * 30_000,
    "x" * 200_000,
    "é combining​ marks\x00 zero",
]
ROWS = [(i, TEXTS[i % len(TEXTS)], 5, "f", "o", "s", 1) for i in range(130)]
ROWS += [(None, TEXTS[0], 5, "f", "o", "s", 1)] * 2 + [(7, TEXTS[0], 5, "f", "o", "s", 1)] * 2


def brute(doc_id, text, fim_percent=50, spm_percent=80, seed=42):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < spm_percent:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("fim_percent, spm_percent", [(50, 80), (100, 50), (0, 0), (100, 100)])
def test_awkward_rows_equal_brute_force(spark, fim_percent, spm_percent):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    done = fim.transform(docs, fim_percent=fim_percent, spm_percent=spm_percent)
    back = done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored_text().alias("text")
    )
    expected = [brute(r[0], r[1], fim_percent, spm_percent) for r in ROWS]
    assert rows_of(back) == sorted(expected, key=repr)
    digests = done.select("output", "output_sha256", "restored_sha256").collect()
    assert all(sha(r.output) == r.output_sha256 for r in digests)
    assert sorted(r.restored_sha256 for r in digests) == sorted(sha(r[1] or "") for r in ROWS)


def test_an_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert fim.transform(nothing).count() == 0


def test_other_sentinels(spark):
    marks = ("<|pre|>", "<|mid|>", "<|suf|>")
    docs = spark.createDataFrame([(i, "some <P> words <M> stand <S> here " * 5) for i in range(40)], "doc_id int, text string")
    done = fim.transform(docs, fim_percent=100, spm_percent=50, sentinels=marks)
    found = done.select("form", "output", fim.restored_text("output", "form", marks).alias("text")).collect()
    assert {r.form for r in found} == {"psm", "spm"}
    assert {r.text for r in found} == {"some <P> words <M> stand <S> here " * 5}
    assert all(r.output.count(m) == 1 for r in found for m in marks)


def test_the_query_equals_brute_force_and_does_not_shuffle(spark, sf_dir):
    found = queries.QUERIES["op12_fim"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = []
    for r in docs:
        *rest, output, text = brute(r.doc_id, r.text)
        expected.append((*rest, sha(output), sha(text)))
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert rows_of(found.select(columns)) == sorted(expected, key=repr)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=5))
def test_splitting_keeps_the_content(data, cuts):
    pieces, buffers = [fim.Piece(fim.TEXT, 0, len(data))], (memoryview(data),)
    for at in cuts:
        if at <= len(data):
            pieces = fim.split(pieces, at)
        else:
            with pytest.raises(ValueError):
                fim.split(pieces, at)
    assert fim.content(pieces, buffers) == data
    assert fim.digest(pieces, buffers) == hashlib.sha256(data).hexdigest()


@given(st.text(), st.permutations(range(6)))
def test_inverse_permutation_restores(text, order):
    pieces = list(text[:6].ljust(6))
    assert fim.permuted(fim.permuted(pieces, order), fim.inverse(order)) == pieces


@given(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c é😀"))
def test_token_ends(text):
    found = [m.end() for m in TOKEN.finditer(text)]
    assert [len(text.encode()[:e].decode()) for e in fim.token_ends(text.encode())] == found


@given(st.text(alphabet="ab <>PSM\n"), st.integers(0, 50), st.integers(0, 50), st.sampled_from(["psm", "spm"]))
def test_output_and_form_are_enough(text, first, second, form):
    data = text.encode()
    n, kind, pieces, marks = fim.rearranged(data, [first, second, 0, 0], 100, 100 if form == "spm" else 0, fim.SENTINELS)
    output = fim.content(pieces, (data, marks))
    assert fim.content(fim.restored(output, kind), (output,)) == data


def test_an_output_without_its_sentinels_is_refused():
    with pytest.raises(ValueError):
        fim.restored(b"<P>a<S>b", "psm")
    with pytest.raises(ValueError):
        fim.restored(b"a", "spm")
