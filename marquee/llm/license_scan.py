"""License scans by template-markup matching.

A template is a license's wording with two kinds of markup::

    <<beginOptional>>...<<endOptional>>                 may be left out
    <<var;name="holder";match="[a-z]+";words="0-8">>    replaceable words

All other words are mandatory and must stand in the text exactly, one after the
other; case, punctuation and line breaks do not count, since texts and templates
are compared as words. ``match`` is a pattern that every word of the replaceable
region must fit as a whole (default: any word), ``words`` how many it may have.

All templates, and the plain base phrases, are compiled into one token
automaton: words are classes, positions in templates are states, and the sets of
positions that can be reached together become the states of a deterministic
automaton, built as texts call for them. A text is read once, word by word, in
pieces of bounded size; the automaton reports which templates end at a word.
Where a template ends, its earliest possible start is found by running that
template alone over the words before (at most its own length).

The scan is one pass over the texts without a shuffle.

Shapes of input: null and empty texts have no words and no labels; long texts
are whole; repeated rows give a row each; empty tables give an empty result;
other columns are ignored. Base places may overlap and are all counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words that stand for a license by themselves: phrase -> label.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Labels and published license wording, with markup.
TEMPLATES = (
    ("mit-notice",
     "<<var;name=\"act\";match=\"released|licensed|distributed|available|provided\";words=\"1-1\">> under the "
     "<<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("mit-text",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "<<var;name=\"work\";words=\"1-3\">> and associated documentation <<beginOptional>>files<<endOptional>>"),
    ("apache-2.0",
     "Licensed under the Apache License, <<beginOptional>>Version<<endOptional>> 2.0"),
    ("apache-2.0-header",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "<<var;name=\"work\";words=\"1-3\">> except in compliance with the License"),
    ("gpl-3.0",
     "licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>GNU<<endOptional>> "
     "General Public License, <<beginOptional>>version<<endOptional>> 3"),
    ("gpl-or-later",
     "General Public License as published by the <<var;name=\"publisher\";words=\"1-4\">> either version "
     "<<var;name=\"version\";match=\"[0-9]+\";words=\"1-2\">> of the License, or (at your option) any later version"),
    ("cc-by-nc-4.0",
     "Licensed under <<beginOptional>>Creative Commons<<endOptional>> CC BY-NC 4.0"),
    ("all-rights-reserved",
     "Copyright <<beginOptional>>(c)<<endOptional>> <<var;name=\"years\";match=\"[0-9]{4}\";words=\"1-2\">> "
     "<<var;name=\"holder\";words=\"1-6\">> All rights reserved"),
)

# Bytes that are no part of a word become spaces, A-Z become a-z.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
PIECE_BYTES = 1 << 20
MAX_STATES = 1 << 16  # deterministic states kept before the table starts anew

_MARK = re.compile(r"<<(.*?)>>", re.DOTALL)
_OPTION = re.compile(r'(\w+)="([^"]*)"')


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Step:
    """One word of a template: exactly ``word``, or any that fits ``match``.

    ``skip`` says how many steps may be left out when they begin here (the
    rest of an optional or replaceable region).
    """

    word: bytes | None = None
    match: str | None = None
    skips: tuple[int, ...] = ()


@dataclass(frozen=True)
class Template:
    name: str
    steps: tuple[Step, ...]

    @property
    def longest(self) -> int:
        return len(self.steps)


def compile_template(name: str, markup: str) -> Template:
    """The steps of a template; regions become steps that may be skipped.

    Raises ``ValueError`` for markup that is not closed or not known, and for a
    template without a mandatory word.
    """
    steps: list[Step] = []
    open_at: list[int] = []
    skips: dict[int, list[int]] = {}
    mandatory = 0
    place = 0
    for mark in [*_MARK.finditer(markup), None]:
        literal = words_of(markup[place : mark.start() if mark else len(markup)].encode())
        steps += [Step(word=w) for w in literal]
        mandatory += 0 if open_at else len(literal)
        if mark is None:
            break
        place, kind, options = mark.end(), mark[1].split(";")[0], dict(_OPTION.findall(mark[1]))
        if kind == "beginOptional":
            open_at.append(len(steps))
        elif kind == "endOptional":
            if not open_at:
                raise ValueError(f"{name}: endOptional without beginOptional")
            start = open_at.pop()
            skips.setdefault(start, []).append(len(steps) - start)
        elif kind == "var":
            least, _, most = options.get("words", "1-1").partition("-")
            least, most = int(least), int(most or least)
            if not 0 <= least <= most:
                raise ValueError(f"{name}: {options['words']!r} is no range of words")
            start = len(steps)
            steps += [Step(match=options.get("match", "")) for _ in range(most)]
            for i in range(least, most):  # after the least number the rest may be left out
                skips.setdefault(start + i, []).append(most - i)
        else:
            raise ValueError(f"{name}: unknown markup <<{kind}>>")
    if open_at:
        raise ValueError(f"{name}: beginOptional without endOptional")
    if not mandatory:
        raise ValueError(f"{name}: no mandatory word")
    return Template(name, tuple(
        Step(s.word, s.match, tuple(k for k in skips.get(i, ()) if k)) for i, s in enumerate(steps)))


class Automaton:
    """All templates as one deterministic token automaton, built on demand.

    A position ``(template, step)`` waits for that step's word. Words that no
    template names and that fit the same patterns share a class, so the tables
    do not grow with the vocabulary of the texts.
    """

    def __init__(self, templates: Sequence[Template], max_states: int = MAX_STATES):
        self.templates, self.max_states = tuple(templates), max_states
        self.words = {s.word for t in templates for s in t.steps if s.word is not None}
        self.patterns = sorted({s.match for t in templates for s in t.steps if s.match})
        self.compiled = [re.compile(p) for p in self.patterns]
        self.begin = self._closed((i, 0) for i in range(len(self.templates)))[0]
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.moves: list[dict] = [{}]
        self.classes: dict[bytes, object] = {}

    def _closed(self, positions) -> tuple[frozenset, frozenset]:
        """Positions with all their skips, and the templates that end here."""
        found, ended, todo = set(), set(), list(positions)
        while todo:
            t, i = todo.pop()
            if (t, i) in found:
                continue
            steps = self.templates[t].steps
            if i == len(steps):
                ended.add(t)
                continue
            found.add((t, i))
            todo += [(t, i + k) for k in steps[i].skips]
        return frozenset(found), frozenset(ended)

    def word_class(self, word: bytes):
        """A named word, else the patterns the word fits."""
        known = self.classes.get(word)
        if known is None:
            text = word.decode("utf-8", "replace")
            fits = tuple(i for i, p in enumerate(self.compiled) if p.fullmatch(text))
            known = (word if word in self.words else None, fits)
            if len(self.classes) >= self.max_states:
                self.classes = {}
            self.classes[word] = known
        return known

    def accepts(self, step: Step, cls) -> bool:
        if step.word is not None:
            return step.word == cls[0]
        return not step.match or self.patterns.index(step.match) in cls[1]

    def step(self, state: int, cls) -> tuple[int, frozenset]:
        """The state after a word of the class, and the templates that end."""
        moved = self.moves[state].get(cls)
        if moved is None:
            here = self.sets[state] | self.begin
            after, ended = self._closed((t, i + 1) for t, i in here if self.accepts(self.templates[t].steps[i], cls))
            if after not in self.ids:
                if len(self.sets) >= self.max_states:
                    self._reset()
                    return self._number(after), ended
                self._number(after)
            moved = self.moves[state][cls] = (self.ids[after], ended)
        return moved

    def _number(self, positions: frozenset) -> int:
        if positions not in self.ids:
            self.ids[positions] = len(self.sets)
            self.sets.append(positions)
            self.moves.append({})
        return self.ids[positions]

    def first_start(self, t: int, before: Sequence[bytes]) -> int:
        """How many of the words ``before`` the longest match of template ``t``
        that ends with the last of them takes."""
        template = self.templates[t]
        classes = [self.word_class(w) for w in before[-template.longest:]]
        for start in range(len(classes)):
            at, _ = self._closed([(t, 0)])
            ended = frozenset()
            for cls in classes[start:]:
                at, ended = self._closed((t, i + 1) for _, i in at if self.accepts(template.steps[i], cls))
            if ended:
                return len(classes) - start
        raise AssertionError("no match ends here")

    def matches(self, pieces: Iterable[list[bytes]]) -> Iterator[tuple[int, int, int]]:
        """(template, first word, word after the last) of every match over the
        words of ``pieces``, which follow one another."""
        keep = max(t.longest for t in self.templates)
        state, offset, tail = 0, 0, []
        for words in pieces:
            for i, word in enumerate(words):
                cls = self.classes.get(word) or self.word_class(word)
                # most words are named by no template and leave nothing waiting
                state, ended = self.moves[state].get(cls) or self.step(state, cls)
                for t in sorted(ended):
                    have = (tail + words[: i + 1]) if i < keep else words[i + 1 - keep : i + 1]
                    end = offset + i + 1
                    yield t, end - self.first_start(t, have), end
            offset += len(words)
            tail = (tail + words)[-keep:]


def text_pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, in pieces of about ``size`` bytes cut between words."""
    folded = text.translate(_FOLD)
    start = 0
    while start < len(folded):
        end = len(folded) if start + size >= len(folded) else folded.find(b" ", start + size)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


SPANS = "array<struct<name: string, first_word: long, end_word: long>>"


def _scan_batches(templates: Sequence[Template], phrases: Sequence[Template]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([*phrases, *templates])
        kind = pa.list_(pa.struct([("name", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))
        for batch in batches:
            counts, base, found = [], [], []
            for text in batch["text"].cast(pa.large_binary()):
                data = text.as_buffer() if text.is_valid else None
                places, spans, n = [], [], 0

                def pieces():
                    nonlocal n
                    for words in text_pieces(data.to_pybytes()) if data is not None else ():
                        yield words
                        n += len(words)

                for t, first, end in automaton.matches(pieces()):
                    span = (automaton.templates[t].name, first, end)
                    (places if t < len(phrases) else spans).append(span)
                counts.append(n)
                base.append([dict(zip(("name", "first_word", "end_word"), s)) for s in places])
                found.append([dict(zip(("name", "first_word", "end_word"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(base, kind), pa.array(found, kind)],
                ["doc_id", "n_words", "base", "found"])

    return run


def scan_licenses(
    documents: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """(doc_id, n_words, base, found) per document: the places of base phrases
    and of templates, each with name, first word and the word after its last."""
    compiled = [compile_template(name, markup) for name, markup in templates]
    plain = [compile_template(label, phrase) for phrase, label in phrases.items()]
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        _scan_batches(compiled, plain), f"doc_id {kind}, n_words long, base {SPANS}, found {SPANS}")


def license_report(documents: DataFrame) -> DataFrame:
    """Digest of ``scan_licenses``. ``score`` is 1 where a template's mandatory
    wording stands, 0.5 where only a base phrase does, and 0 elsewhere."""
    scanned = scan_licenses(documents)
    names = lambda *spans: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.col(s)["name"] for s in spans]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base")["first_word"]).alias("first_word"),
        F.array_max(F.col("base")["first_word"]).alias("last_word"),
        names("base").alias("base_labels"),
        names("base", "found").alias("labels"),
        F.when(F.size("found") > 0, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0).alias("score"),
    )
