"""Fill-in-middle: outputs equal a plain construction and every text comes back exactly."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from strata.llm.fim import arrange, rearrange, restore, rotate, transform
from strata.llm.fim_queries import op11_fill_in_middle

ODD = [None, "", "a", "<", "<P>", "x <S> y", "ab<M", "Ünï cödé 世界 😀", "a\x00b\n\n c", "<<S", "P>S>M>" * 3, "word " * 50000,
       "no sentinel < P > here", "ÿ" * 300, "<S", ">"]


def expected(key, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_odd_texts_repeated_ids_and_clashing_columns(spark):
    data = [(i % 97 if i else None, t, "n", "f") for i, t in enumerate(ODD * 12)]
    docs = spark.createDataFrame(data, "doc_id long, text string, form string, output string")
    out = restore(transform(docs)).collect()
    got = sorted(((r.doc_id, r.text, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in out), key=repr)
    assert got == sorted(((i, t, expected(i, t)) for i, t, *_ in data), key=repr)
    assert all(r.restored == (r.text or "") for r in out)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert docs.columns == transform(docs).columns[:2] + ["form", "output"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert restore(transform(docs)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>PSMab é", max_size=30).filter(lambda t: not re.search("<[PSM]>", t)), st.data())
def test_inverse_at_any_cut(text, data):
    body = text.encode()
    a = data.draw(st.integers(0, len(body)))
    b = data.draw(st.integers(a, len(body)))
    for form in ("psm", "spm"):
        assert bytes(rearrange(bytes(arrange(body, a, b, form)), form)) == body


def test_rotation_is_in_place():
    v = np.arange(10, dtype=np.uint8)
    rotate(v, 2, 5, 9)
    assert v.tolist() == [0, 1, 5, 6, 7, 8, 2, 3, 4, 9]


def test_query_equals_plain_construction(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op11_fill_in_middle(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        n, form, p, m, output = expected(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
