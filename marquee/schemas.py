"""Table specifications: raw inputs, lake datasets and serving tables.

Everything here is data, not logic: column lists, Spark types, partition
keys, sort keys and the value ranges of the serving types.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Raw inputs. Every raw column arrives as a string; only the columns the
# builders use are listed (real files may carry more, matched by header name).
# --------------------------------------------------------------------------

RAW_BASICS = "title.basics"
RAW_RATINGS = "title.ratings"
RAW_EPISODE = "title.episode"
RAW_NAMES = "name.basics"
RAW_AKAS = "title.akas"
RAW_PRINCIPALS = "title.principals"

RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    RAW_BASICS: (
        "tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
        "startYear", "endYear", "runtimeMinutes", "genres",
    ),
    RAW_RATINGS: ("tconst", "averageRating", "numVotes"),
    RAW_EPISODE: ("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
    RAW_NAMES: (
        "nconst", "primaryName", "birthYear", "deathYear",
        "primaryProfession", "knownForTitles",
    ),
    RAW_AKAS: (
        "titleId", "ordering", "title", "region", "language", "types",
        "isOriginalTitle",
    ),
    RAW_PRINCIPALS: ("tconst", "ordering", "nconst", "category", "job", "characters"),
}

# Only title.basics is required; the rest switch datasets on or off.
REQUIRED_RAW = (RAW_BASICS,)

# Fixed values of the raw format and of the cleaning rules.
RAW_NULL_TOKEN = "\\N"          # the two characters backslash and N
UNKNOWN = "Unknown"             # default for missing categorical text
LIST_SEPARATOR = ","            # separator of multi-valued raw columns
SERIES_TYPE = "tvSeries"        # parent type matched by the episode builder
EPISODE_TYPE = "tvEpisode"      # child type used by the episode fallback
NON_ADULT_FLAG = "0"            # raw isAdult value kept by clean_basics


def _s(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable)


def _i(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.IntegerType(), nullable)


def _l(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.LongType(), nullable)


def _f(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.FloatType(), nullable)


def _h(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.ShortType(), nullable)


# --------------------------------------------------------------------------
# Lake datasets
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class LakeSpec:
    name: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    # Columns that identify a row across versions: a row that comes again with
    # another partition value replaces the old one.
    key: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


TITLES = LakeSpec(
    "titles",
    T.StructType([
        _s("tconst"), _s("title_type"), _s("primary_title"), _s("original_title"),
        _i("start_year"), _i("end_year"), _i("runtime_minutes"), _s("genres"),
        _s("primary_genre"), _f("average_rating"), _l("num_votes"),
    ]),
    ("start_year", "title_type"),
    ("tconst",),
)

EPISODES = LakeSpec(
    "episodes",
    T.StructType([
        _s("episode_tconst"), _s("parent_tconst"), _i("season_number"),
        _i("episode_number"), _s("episode_title"), _s("series_title"),
        _i("start_year"), _s("primary_genre"), _f("average_rating"),
        _l("num_votes"), _i("runtime_minutes"),
    ]),
    ("start_year", "primary_genre"),
    ("episode_tconst",),
)

NAMES = LakeSpec(
    "names",
    T.StructType([
        _s("nconst"), _s("primary_name"), _i("birth_year"), _i("death_year"),
        _s("primary_profession"), _s("primary_role"), _s("known_for_titles"),
    ]),
    ("primary_role",),
    ("nconst",),
)

AKAS = LakeSpec(
    "akas",
    T.StructType([
        _s("title_id"), _i("ordering"), _s("title"), _s("region"), _s("language"),
        _s("types"), _i("is_original_title"),
    ]),
    ("region",),
    ("title_id", "ordering"),
)

PRINCIPALS = LakeSpec(
    "principals",
    T.StructType([
        _s("tconst"), _i("ordering"), _s("nconst"), _s("primary_name"),
        _s("category"), _s("job"), _s("characters"), _s("title_type"),
        _s("primary_title"), _s("primary_genre"), _i("birth_year"),
        _s("primary_role"),
    ]),
    ("category",),
    ("tconst", "ordering"),
)

LAKE: dict[str, LakeSpec] = {s.name: s for s in (TITLES, EPISODES, NAMES, AKAS, PRINCIPALS)}

# Order in which the pipeline builds and reports the datasets.
DATASET_ORDER = ("titles", "episodes", "names", "akas", "principals")

# The largest datasets: written one after another, so that the shuffle files of
# only one of them are on disk at a time.
FACTS = ("episodes", "principals")

# --------------------------------------------------------------------------
# Serving tables
# --------------------------------------------------------------------------

# Unsigned ranges of the serving types. Spark has no unsigned integers and its
# wider types hold the values outside, which are kept and reported.
UINT8_MAX = 255
UINT16_MAX = 65_535
UINT32_MAX = 4_294_967_295


@dataclass(frozen=True)
class ServingSpec:
    name: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    # Sort key inside each partition: column names, or (column, default) for
    # a null-defaulted key (``ifNull(col, default)``).
    sort_by: tuple
    # Upper bound of each unsigned column (lower bound is 0).
    unsigned_max: dict = field(default_factory=dict)
    # Numeric columns whose nulls take a default: non-null columns and the year
    # of the partition key.
    numeric_defaults: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


SERVING_DATABASE = "marquee"

SERVING_TITLES = ServingSpec(
    "titles",
    T.StructType([
        _s("tconst", False), _s("title_type", False), _s("primary_title", False),
        _s("original_title", False), _i("start_year"), _i("end_year"),
        _l("runtime_minutes"), _s("genres", False), _s("primary_genre", False),
        _f("average_rating"), _l("num_votes"),
    ]),
    ("start_year",),
    ("title_type", "primary_genre", "tconst"),
    {"start_year": UINT16_MAX, "end_year": UINT16_MAX,
     "runtime_minutes": UINT32_MAX, "num_votes": UINT32_MAX},
    {"start_year": 0},
)

SERVING_EPISODES = ServingSpec(
    "episodes",
    T.StructType([
        _s("episode_tconst", False), _s("parent_tconst", False), _i("season_number"),
        _i("episode_number"), _s("episode_title", False), _s("series_title", False),
        _i("start_year"), _s("primary_genre", False), _f("average_rating"),
        _l("num_votes"), _l("runtime_minutes"),
    ]),
    ("start_year",),
    ("parent_tconst", ("season_number", 0), ("episode_number", 0)),
    {"season_number": UINT16_MAX, "episode_number": UINT16_MAX,
     "start_year": UINT16_MAX, "num_votes": UINT32_MAX,
     "runtime_minutes": UINT32_MAX},
    {"start_year": 0},
)

SERVING_NAMES = ServingSpec(
    "names",
    T.StructType([
        _s("nconst", False), _s("primary_name", False), _i("birth_year"),
        _i("death_year"), _s("primary_profession", False), _s("primary_role", False),
        _s("known_for_titles", False),
    ]),
    ("primary_role",),
    ("primary_name", "nconst"),
    {"birth_year": UINT16_MAX, "death_year": UINT16_MAX},
)

SERVING_AKAS = ServingSpec(
    "akas",
    T.StructType([
        _s("title_id", False), _i("ordering", False), _s("title", False),
        _s("region", False), _s("language", False), _s("types", False),
        _h("is_original_title", False),
    ]),
    ("region",),
    ("title_id", "ordering"),
    {"ordering": UINT16_MAX, "is_original_title": UINT8_MAX},
    {"ordering": 0, "is_original_title": 0},
)

SERVING_PRINCIPALS = ServingSpec(
    "principals",
    T.StructType([
        _s("tconst", False), _i("ordering", False), _s("nconst", False),
        _s("primary_name", False), _s("category", False), _s("job", False),
        _s("characters", False), _s("title_type", False), _s("primary_title", False),
        _s("primary_genre", False), _i("birth_year"), _s("primary_role", False),
    ]),
    ("category",),
    ("tconst", "ordering", "nconst"),
    {"ordering": UINT16_MAX, "birth_year": UINT16_MAX},
    {"ordering": 0},
)

SERVING: dict[str, ServingSpec] = {
    s.name: s for s in (SERVING_TITLES, SERVING_EPISODES, SERVING_NAMES,
                        SERVING_AKAS, SERVING_PRINCIPALS)
}

# The titles dataset must exist for a serving refresh; the others are optional.
REQUIRED_SERVING = ("titles",)
