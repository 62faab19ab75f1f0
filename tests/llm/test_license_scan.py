"""License templates: markup, the automaton against patterns, spans, odd texts."""

import random
import re

import pytest

from marquee.llm import license_scan as L

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pattern(markup):
    """The template as a regular expression over space-framed words."""
    out = []
    for part in re.split(r"(<<.*?>>)", markup):
        if part == "<<beginOptional>>":
            out.append("(?:")
        elif part == "<<endOptional>>":
            out.append(")?")
        elif part.startswith("<<var"):
            options = dict(re.findall(r'(\w+)="([^"]*)"', part))
            low, _, high = options.get("words", "1-1").partition("-")
            out.append(f"(?:(?:{options.get('match') or '[^ ]+'}) ){{{low},{high or low}}}")
        else:
            out += [re.escape(w) + " " for w in words(part)]
    return re.compile("(?<= )" + "".join(out))


def ends_by_pattern(name_markup, text):
    """(name, end) of every place where some match of the template ends."""
    toks = words(text)
    found = set()
    for name, markup in name_markup:
        rule = re.compile(pattern(markup).pattern + r"\Z")
        for end in range(1, len(toks) + 1):
            if rule.search(" " + "".join(t + " " for t in toks[max(0, end - 60):end])):
                found.add((name, end))
    return found


def scan(text, templates, size=7):
    automaton = L.Automaton([L.compile_template(*t) for t in templates], max_states=9)
    return [(automaton.templates[t].name, first, end)
            for t, first, end in automaton.matches(L.text_pieces(text.encode(), size))]


MARKUP = [
    ("plain", "a b a"),
    ("optional", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> e"),
    ("any", 'b <<var;words="0-2">> a'),
    ("years", 'c <<var;match="[0-9]{4}";words="1-2">> <<beginOptional>>d<<endOptional>>'),
    ("ends", 'd <<beginOptional>>e<<endOptional>>'),
]


def test_automaton_against_patterns():
    rng = random.Random(3)
    for _ in range(300):
        text = " ".join(rng.choice(["a", "b", "c", "d", "e", "1999", "20", "x", "É"]) for _ in range(rng.randrange(0, 25)))
        got = scan(text, MARKUP)
        assert {(n, e) for n, _, e in got} == ends_by_pattern(MARKUP, text), text
        assert len(got) == len({(n, e) for n, _, e in got})
        toks = words(text)
        for name, first, end in got:   # the longest match that ends there
            rule = re.compile(pattern(dict(MARKUP)[name]).pattern + r"\Z")
            fits = [s for s in range(end) if rule.match(" " + "".join(t + " " for t in toks[s:end]), 1)]
            assert first == min(fits)


def test_mandatory_wording_is_exact():
    yes = ["Licensed under the Apache License, Version 2.0.", "LICENSED under the\napache-license 2.0"]
    no = ["Licensed under Apache License, Version 2.0", "Licensed under the Apache License, Version 2",
          "Licensed under the old Apache License, Version 2.0"]
    for text in yes:
        assert "apache-2.0" in {n for n, _, _ in scan(text, L.TEMPLATES)}
    for text in no:
        assert "apache-2.0" not in {n for n, _, _ in scan(text, L.TEMPLATES)}
    notice = "(c) Copyright (c) 2019 2021 The Example Authors. All rights reserved."
    assert scan(notice, L.TEMPLATES) == [("all-rights-reserved", 1, 11)]


@pytest.mark.parametrize("markup", ["a <<beginOptional>> b", "a <<endOptional>>", "a <<what>>", '<<var;words="0-3">>',
                                    "<<beginOptional>>a<<endOptional>>", 'a <<var;words="3-1">>'])
def test_bad_markup_raises(markup):
    with pytest.raises(ValueError):
        L.compile_template("t", markup)


def brute(text):
    toks = words(text)
    places = [(label, i) for phrase, label in L.PHRASES.items() for i in range(len(toks))
              if toks[i:i + len(phrase.split())] == phrase.split()]
    line = " " + "".join(t + " " for t in toks)
    found = {name for name, markup in L.TEMPLATES if pattern(markup).search(line)}
    base = {label for label, _ in places}
    starts = [i for _, i in places]
    return (len(toks), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), 1.0 if found else 0.5 if base else 0.0)


TEXTS = [
    None, "", " \n\t", "mit license", "MIT-License MIT license mit  LICENSE", "mitlicense mit licenses", "mit é license",
    "Released under the MIT License.", "released under the terms of the mit license",
    "This work is licensed under the GNU General Public License, version 3.", "general public license 3",
    "Licensed under CC BY-NC 4.0.", "word " * 40_000 + "apache license" + " w" * 9_000 + " Mit License",
    "apache\x00license", "apache license apache license apache license",
    "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
    "or (at your option) any later version",
]


def test_report_against_brute_force(workers):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", "y"), (None, TEXTS[7], None, None)]
    df = workers.createDataFrame(rows, "doc_id long, text string, labels string, n_words string").repartition(3)
    got = [tuple(r) for r in L.license_report(df).collect()]
    assert sorted(got, key=str) == sorted([(d, *brute(t)) for d, t, _, _ in rows], key=str)


def test_whole_corpus_and_spans(workers, documents, empty):
    assert L.license_report(empty).collect() == []
    got = {r["doc_id"]: tuple(r)[1:] for r in L.license_report(documents).collect()}
    assert got == {r["doc_id"]: brute(r["text"]) for r in documents.collect()}
    df = workers.createDataFrame([(1, "so: Released under the MIT License!")], "doc_id long, text string")
    row = L.scan_licenses(df).first()
    assert [tuple(s) for s in row.base] == [("mit", 4, 6)]
    assert [tuple(s) for s in row.found] == [("mit-notice", 1, 6)]
