"""Fill in the middle: the wavelet matrix against plain counts, cuts against a plain version, and round trips."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tabwright.llm import fim, queries

PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[ \t-\r]*[^ \t-\r]*[ \t-\r]*", "char": r"(?s:.)"}


def units(text: str, unit: str) -> list[str]:
    if unit != "word":
        return re.findall(PATTERNS[unit], text)
    # A word takes the blanks behind it; blanks at the begin are a unit of their own.
    return re.findall(r"[^ \t-\r]+[ \t-\r]*|^[ \t-\r]+", text)


def plain(key, text, unit="line", seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    parts = units(text, unit)
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        form, out, chars = "plain", text, (None, None)
    elif h[3] % 100 < spm:
        form, out, chars = "spm", f"<S>{suf}<P>{pre}<M>{mid}", (len(pre), len(mid))
    else:
        form, out, chars = "psm", f"<P>{pre}<S>{suf}<M>{mid}", (len(pre), len(mid))
    return key, n, form, *chars, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), out


@given(st.lists(st.integers(0, 7), max_size=300), st.integers(0, 7), st.data())
def test_ranks_and_places(symbols, symbol, data):
    x = np.array(symbols, np.uint8)
    matrix = fim.WaveletMatrix(x)
    at = np.arange(len(x) + 1)
    assert matrix.rank(symbol, at).tolist() == [int((x[:i] == symbol).sum()) for i in at]
    chosen = (1, 3, symbol) if symbol not in (1, 3) else (1, 3)
    ends = np.flatnonzero(np.isin(x, chosen)) + 1
    low = data.draw(st.integers(0, len(x)))
    later = ends[ends > low]
    n = data.draw(st.integers(0, len(later) + 2))
    want = low if n == 0 else int(later[n - 1]) if n <= len(later) else len(x)
    assert matrix.after(chosen, np.array([n]), np.array([low]), np.array([len(x)])).tolist() == [want]


ODD = [None, "", "\n", "\n\n", "no break", "a\n", "a\nb", "\na", "ä\nöü\n日本語\n\n👩‍👩", "has <P> inside\nx", "has <S>\n", "<M>", "<P<S", "<\n<\n<S\n>", "\r\n\r\n", " lead", "tail ", "\x00\n\x00", "x y\u0085z\n"]


@pytest.mark.parametrize("unit", ["line", "word", "char"])
def test_equals_the_plain_version(spark, unit):
    texts = [*ODD, "line of a long text\n" * 120_000, "x" * 1_500_000, *[f"{i} words and\nlines é\n" * (i % 9) for i in range(300)]]
    rows = [(i if i % 7 else None, t, 3, "f") for i, t in enumerate(texts)] + [(5, "the same\nagain\n", 1, "g")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, form string").repartition(5)
    found = [tuple(r) for r in fim.transform(docs, unit=unit, rate=80).collect()]
    want = [plain(r[0], r[1], unit, rate=80) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert all(r[6] == hashlib.sha256(fim.restored(r[7].encode(), r[2])).hexdigest() for r in found)


@given(st.text(alphabet="<PSM>\n a", max_size=12), st.text(alphabet="<PSM>\n a", max_size=12), st.text(alphabet="<PSM>\n a", max_size=12), st.booleans())
def test_outputs_can_be_taken_apart(pre, mid, suf, first):
    whole = pre + mid + suf
    if not any(m in whole for m in ("<P>", "<S>", "<M>")):
        form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if first else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
        assert fim.restored(out.encode(), form) == whole.encode()


def test_query_equals_the_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    found = [tuple(r) for r in queries.op11_fill_in_middle(spark, folder).collect()]
    want = [plain(r["doc_id"], r["text"])[:-1] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id string, text string")).count() == 0
