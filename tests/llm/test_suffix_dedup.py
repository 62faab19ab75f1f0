import hashlib
import re

import numpy as np
import pytest

from marquee.llm.suffix_dedup import later_copies, previous_smaller, suffix_dedup, suffix_report


def brute(rows, length=100):
    seen, out = set(), {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            k = b[i : i + length]
            if k in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(k)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def answer(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"hot_blocks": 1}, {"hot_blocks": 4}, {"length": 40}, {"length": 65, "hot_blocks": 2}])
def test_matches_brute_force(documents, rows, options):
    want = brute(rows, options.get("length", 100))
    assert answer(suffix_report(documents, **options)) == want
    assert sum(v[1] for v in want.values()) > 5_000


def test_a_seed_repeated_within_few_documents_is_split(workers, monkeypatch):
    """Rows of one template inside few texts: the group is bounded in blocks."""
    from marquee.llm import suffix_dedup as S

    line = "the same wording in every row of this table 0123456789 ends here"
    texts = [" | ".join(f"{t * 1000 + i:06d} {line} {i * 7:06d} {line[::-1]}" for i in range(400)) for t in range(3)]
    rows = list(enumerate(texts))
    frame = workers.createDataFrame(rows, "doc_id long, text string")
    want, groups, real = brute(rows), [], S._factors
    assert answer(suffix_report(frame)) == want

    def watched(blocks, length):
        groups.append(blocks.groupBy("key").count().agg({"count": "max"}).first()[0] or 0)
        return real(blocks, length)

    monkeypatch.setattr(S, "_factors", watched)
    assert answer(suffix_report(frame, hot_blocks=100)) == want
    cold, hot = groups
    assert cold <= 100 and hot > 0
    assert workers.createDataFrame([(0, texts[0])], "doc_id long, text string").transform(S.suffix_report).count() == 1


def test_long_text_in_pieces(workers):
    rng = np.random.default_rng(3)
    body = "".join(chr(97 + x) for x in rng.integers(0, 26, 1_200_000))
    rows = [(1, body + "|" + body[5_000:9_000]), (2, "z" + body[1_048_500:1_048_700] + "q")]
    frame = workers.createDataFrame(rows, "doc_id long, text string")
    got = answer(suffix_report(frame))
    assert got[1][1:3] == (4_000, 1) and got[2][1:3] == (200, 1)


def test_previous_smaller_and_factors():
    rng = np.random.default_rng(1)
    for values in (rng.permutation(200), np.arange(50), np.arange(50)[::-1].copy()):
        want = []
        for i, v in enumerate(values):
            j = i - 1
            while j >= 0 and values[j] > v:
                j -= 1
            want.append(j)
        assert previous_smaller(values).tolist() == want
    text = rng.integers(0, 2, 400).astype(np.uint8)
    for length in (9, 16, 17, 33):
        starts = np.arange(len(text) - length + 1)
        seen, want = set(), []
        for i in starts:
            k = text[i : i + length].tobytes()
            want.append(k in seen)
            seen.add(k)
        assert later_copies(text, starts, length).tolist() == want


def test_shapes(empty, clashing, with_nulls, rows):
    assert suffix_report(empty).count() == 0
    assert answer(suffix_report(clashing)) == brute(rows)
    got = suffix_dedup(with_nulls).collect()
    assert len(got) == with_nulls.count()
    want = brute(rows)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)
