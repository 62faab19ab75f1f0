from __future__ import annotations

import gzip
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from marquee.session import build_session  # noqa: E402

N = "\\N"  # the raw null token

# Hand-written raw rows (FIXTURES.md §4): edge cases with outputs worked out
# by hand in the tests.
BASICS = [
    ("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult", "startYear",
     "endYear", "runtimeMinutes", "genres"),
    ("tt01", "movie", "Alpha", "Alpha", "0", "1994", N, "142", "Drama,Crime"),
    ("tt02", "tvSeries", "Beta", "Beta", "0", "2008", "2013", "45", "Crime"),
    ("tt03", "tvEpisode", "Pilot", "Pilot", "0", N, N, "58", N),
    ("tt04", "movie", "Adult", "Adult", "1", "2000", N, "90", "Adult"),
    ("tt05", "tvMiniSeries", "Gamma", "Gamma", "0", "2019", "2019", N, "Drama"),
    ("tt06", "movie", '"Open title', '"Open title', "0", "abc", N, "x", ""),
    ("tt07", "tvEpisode", "Part 1", "Part 1", "0", "2019", N, "60", "Drama"),
    ("tt08", "movie", "Shifted", "Shifted", N, "2001", N, "80", "Drama"),
    ("tt09", "movie", "Odd flag", "Odd flag", "title", "2001", N, "80", "Drama"),
]
RATINGS = [
    ("tconst", "averageRating", "numVotes"),
    ("tt01", "9.3", "2700000"),
    ("tt02", "9.5", "2000000"),
    ("tt99", "5.0", "10"),
]
EPISODE = [
    ("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
    ("tt03", "tt02", "1", "1"),
    ("tt07", "tt05", "1", "1"),
    ("tt98", "tt97", N, N),
]
NAMES = [
    ("nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"),
    ("nm1", "Ann A", "1950", N, "actress,producer", "tt01"),
    ("nm2", "Bob B", N, N, N, N),
]
AKAS = [
    ("titleId", "ordering", "title", "region", "language", "types", "isOriginalTitle"),
    ("tt01", "1", "Alfa", "US", "en", "display", "0"),
    ("tt01", "2", "Alpha", N, N, "original", "1"),
    ("tt01", "3", "Alpha3", "01", "en", N, "0"),
]
PRINCIPALS = [
    ("tconst", "ordering", "nconst", "category", "job", "characters"),
    ("tt01", "1", "nm1", "actress", N, "Role"),
    ("tt01", "2", "nm2", N, "writer", N),
    ("tt01", "3", "nm9", "director", N, N),
    ("tt04", "1", "nm1", "actress", N, N),
]

RAW_FILES = {
    "title.basics": BASICS,
    "title.ratings": RATINGS,
    "title.episode": EPISODE,
    "name.basics": NAMES,
    "title.akas": AKAS,
    "title.principals": PRINCIPALS,
}


def write_tsv(path: Path, rows, gz: bool = False) -> Path:
    text = "".join("\t".join(r) + "\n" for r in rows)
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as fh:
            fh.write(text)
    else:
        path.write_text(text, encoding="utf-8")
    return path


def make_raw_dir(base: Path, names=None, gz=()) -> Path:
    """A raw directory holding the chosen fixture files (all by default)."""
    base.mkdir(parents=True, exist_ok=True)
    for name, rows in RAW_FILES.items():
        if names is not None and name not in names:
            continue
        suffix = ".tsv.gz" if name in gz else ".tsv"
        write_tsv(base / f"{name}{suffix}", rows, gz=name in gz)
    return base


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="marquee-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_dir(tmp_path_factory) -> Path:
    # title.episode as gzip: both suffixes are exercised.
    return make_raw_dir(tmp_path_factory.mktemp("raw"), gz={"title.episode"})


@pytest.fixture(scope="session")
def raw(spark, raw_dir):
    from marquee import schemas as S
    from marquee.sources import read_raw_inputs

    return read_raw_inputs(
        spark, str(raw_dir), S.REQUIRED_RAW,
        (S.RAW_RATINGS, S.RAW_EPISODE, S.RAW_PRINCIPALS, S.RAW_AKAS, S.RAW_NAMES),
    )


@pytest.fixture(scope="session")
def built(raw):
    from marquee.plans import build_all

    return build_all(raw)
