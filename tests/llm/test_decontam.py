import hashlib
import re

import pytest
from cases import SCHEMA, bag, clashing, docs, empty, rows

from tagloom.llm import decontam

ITEMS = "item_id long, text string"


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(documents, items, window):
    grams = []
    for item, text in items:
        w = split(text)
        if w:
            n = min(window, len(w))
            grams += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)]
    out = []
    for d, text, *_ in documents:
        w = split(text)
        hit, who = set(), set()
        for item, g in grams:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    who.add(item)
        ids = sorted(str(x) for x in who if x is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def sample():
    r = rows(1)
    cut = lambda i, a, b: " ".join((r[i][1] or "").split()[a:b])
    items = [
        (1, cut(2, 0, 9).upper()),
        (2, cut(4, 3, 30)),
        (2, cut(8, 0, 12)),
        (3, cut(9, 0, 3)),  # shorter than a window
        (None, cut(10, 0, 8)),
        (4, ""),
        (5, None),
        (6, "never seen words at all"),
        (7, cut(4, 3, 30)),
    ]
    r.append((900, f"{cut(4, 3, 30)}; {cut(9, 0, 3)}!", "en", "a", 1))
    return r, items


@pytest.mark.parametrize("block_words", [5, 1000])
def test_report_equals_brute_force(spark, block_words):
    r, items = sample()
    got = decontam.contamination_report(
        clashing(spark.createDataFrame(r, SCHEMA)), spark.createDataFrame(items, ITEMS), window=6, block_words=block_words
    )
    assert bag(got) == brute(r, items, 6)


@pytest.mark.parametrize("block_words", [5, 1000])
def test_removal_leaves_no_match_and_clean_rows_alone(spark, block_words):
    r, items = sample()
    given = clashing(spark.createDataFrame(r, SCHEMA))
    out = decontam.decontaminate(given, spark.createDataFrame(items, ITEMS), window=6, block_words=block_words)
    assert out.columns == given.columns
    left = [(x["doc_id"], x["text"]) for x in out.collect()]
    assert not any(h for _, _, h, *_ in brute(left, items, 6))
    whole = decontam.decontaminate(given, spark.createDataFrame(items, ITEMS), window=6)
    assert bag(out) == bag(whole)
    clean = {(d, t) for (d, t, *_), (*_, hit) in zip(sorted(r, key=repr), [x[5:] for x in brute(r, items, 6)], strict=False) if not hit}
    hits = {x[0] for x in brute(r, items, 6) if x[5]}
    clean = [(d, t) for d, t, *_ in r if d not in hits]
    assert all(left.count(c) == clean.count(c) for c in clean)
    for x in out.collect():
        if x["doc_id"] in hits and x["text"] is not None:
            assert x["n_chars"] == len(x["text"]) or (x["doc_id"], x["text"]) in {(d, t) for d, t, *_ in r}


def test_mostly_matched_documents_go(spark):
    r, items = sample()
    out = decontam.decontaminate(spark.createDataFrame(r, SCHEMA), spark.createDataFrame(items, ITEMS), window=6)
    assert 900 not in {x["doc_id"] for x in out.collect()}


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    d = docs(spark)
    assert bag(decontam.decontaminate(d, none)) == bag(d)
    assert all(not x["contaminated"] for x in decontam.contamination_report(d, none).collect())
    some = spark.createDataFrame([(1, "a b c")], ITEMS)
    assert decontam.contamination_report(empty(spark), some).count() == 0
    assert decontam.decontaminate(empty(spark), some).count() == 0


def test_cutting_joins_words_into_a_new_match():
    sam = decontam.Automaton([("i", b"a b c d"), ("j", b"p q r s")], window=4)
    text, removed = decontam.clean(b"x p q a b c d r s y", sam)
    assert text.split() == [b"x", b"y"] and removed == 8


@pytest.mark.parametrize("block_words", [10, 1000])
def test_cuts_that_join_matches_of_other_blocks(spark, block_words):
    a, b = [f"w{i}" for i in range(10)], [f"x{i}" for i in range(10)]
    text = " ".join([*a[:5], *b, *a[5:]])
    given = spark.createDataFrame([(1, f"{'p ' * 30}{text} end", None, None, 0), (2, text, None, None, 0)], SCHEMA)
    items = spark.createDataFrame([("a", " ".join(a)), ("b", " ".join(b))], "item_id string, text string")
    out = decontam.decontaminate(given, items, block_words=block_words)
    assert [(r["doc_id"], r["text"].split(), r["n_chars"]) for r in out.collect()] == [(1, ["p"] * 30 + ["end"], len("p " * 30 + " end"))]
