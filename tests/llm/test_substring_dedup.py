import hashlib
import re

import pytest

from marquee.llm.substring_dedup import dedup_windows, window_report


def brute(rows, window=50):
    first, words = {}, {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", t or "")
        words[d] = w
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, w in words.items():
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                keep[i : i + window] = [False] * window
        kept = " ".join(x for x, k in zip(w, keep) if k)
        out[d] = (len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest())
    return out


def answer(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("window, gram", [(50, 16), (20, 5), (6, 6)])
def test_matches_brute_force(documents, rows, window, gram):
    want = brute(rows, window)
    assert answer(window_report(documents, window=window, gram=gram)) == want
    assert sum(n for _, n, _ in want.values()) > 500


def test_hot_windows_are_not_joined_by_shuffle(workers):
    """Windows above the bound go through the small side, with equal rows."""
    from marquee.llm.substring_dedup import later_windows

    rows = [(w, w * 7, d, d % 5) for w, n in ((1, 300), (2, 40), (3, 1), (4, 2)) for d in range(n)]
    rows += [(1, 8, 900 + d, 0) for d in range(3)]                      # one hash alike, the other not
    frame = workers.createDataFrame(rows, "window long, check long, doc_id long, at int")
    want = sorted([(d, d % 5) for n in (300, 40, 2) for d in range(1, n)] + [(901, 0), (902, 0)])
    for hot_windows, hot_rows in ((1_024, 4_096), (10, 20), (1 << 40, 0), (4, 0)):
        assert sorted(map(tuple, later_windows(frame, hot_windows, hot_rows).collect())) == want


def test_spans_and_text(documents, rows):
    text = dict(rows)
    for r in dedup_windows(documents).collect():
        words = re.findall(r"[^\x20\x09-\x0d]+", text[r.doc_id] or "")
        gone = {i for a, z in r.spans for i in range(a, z)}
        assert len(gone) == r.n_removed
        assert all(z - a >= 50 for a, z in r.spans)
        assert r.kept_text == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_shapes(empty, clashing, with_nulls, rows):
    assert window_report(empty).count() == 0
    assert answer(window_report(clashing)) == brute(rows)
    got = window_report(with_nulls).collect()
    assert len(got) == with_nulls.count()
    want = brute(rows)
    assert all((r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)
