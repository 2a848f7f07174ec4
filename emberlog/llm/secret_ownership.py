"""Secret scans with corpus-wide ownership frequency, with DataFrame functions only.

Fixed patterns find assignments, access keys and long hexadecimal runs; bare tokens that mix letters
and digits are candidates too. The values of all candidates are hashed and counted over the corpus by
distinct repositories and owners. A value seen with many owners or repositories is a widely copied
example; one that stays with few is owner-specific and looks live: its place is added as a ``live`` span.

Counting goes by (value, owner, repository), then (value, owner), then value, each summed before it
is shuffled, so a value that a third of all texts share is never gathered.

Places: ``split`` gives the gaps between matches and ``regexp_extract_all`` the matches, so running
lengths give starts and ends in code points.

Defined cases: a null text is empty. Rows equal in id, owner and text get equal spans. A null owner or
repository counts as one of its own. Input columns are read by name only and never clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.session import stored


def _either_case(pattern: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


# The base patterns. A run of fewer characters than asked for never matches; for an
# assignment the length is asked of the value afterwards, as a short match still uses up its text.
ASSIGN = "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BARE = "[A-Za-z0-9+/_-]{20,}"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "live")

MAX_OWNERS = 1
MAX_REPOSITORIES = 3

_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _spans(text: Column, pattern: str, group: int, kind: int, keep) -> Column:
    """Matches as structs (start, kind, end, value); none without a search if the text has no match."""
    none = F.array().cast(_SPANS)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def step(state, piece):
        start = state["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["whole"]), F.lit(0))
        found = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), piece["value"].alias("value"))).cast(_SPANS)
        return F.struct(end.alias("at"), F.when(F.coalesce(keep(piece["value"]), F.lit(False)), F.concat(state["found"], found)).otherwise(state["found"]).alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda s: s["found"])).otherwise(none)


def scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source", repository: str = "doc_id",
         max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per input row: ``doc_id``, ``base`` and ``live`` spans as arrays of (start, kind, end, value), ``kind`` an index into ``KINDS``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    any_value = lambda v: v.isNotNull()
    read = df.select(F.col(doc_id).alias("doc_id"), F.col(owner).alias("owner"), F.col(repository).cast("string").alias("repository"), whole.alias("t"))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.md5("owner"), F.lit("null")), F.md5("t")))
    found = read.select("doc_id", "owner", "repository", key.alias("row_key"),
                        _spans(F.col("t"), ASSIGN, 2, 0, lambda v: F.length(v) >= ASSIGN_VALUE).alias("assign"),
                        _spans(F.col("t"), ACCESS, 0, 1, any_value).alias("access"), _spans(F.col("t"), HEX, 0, 2, any_value).alias("hex"),
                        _spans(F.col("t"), BARE, 0, 3, lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")).alias("bare"))
    found = stored(found.select("doc_id", "owner", "repository", "row_key", F.sort_array(F.concat("assign", "access", "hex")).alias("base"), "bare"))

    candidates = found.filter((F.size("base") > 0) | (F.size("bare") > 0)).select("owner", "repository", "row_key", F.explode(F.concat("base", "bare")).alias("c"))
    candidates = candidates.select("owner", "repository", "row_key", F.md5("c.value").alias("secret"), F.col("c.value").alias("value"), F.col("c.end").alias("end"))
    live = owner_specific(candidates, max_owners, max_repositories)
    span = F.struct((F.col("end") - F.length("value")).alias("start"), F.lit(3).alias("kind"), F.col("end"), F.col("value"))
    places = candidates.join(live, "secret").groupBy("row_key").agg(F.sort_array(F.collect_set(span)).alias("live"))
    joined = found.join(places, "row_key", "left")
    return joined.select("doc_id", "base", F.coalesce("live", F.array().cast(_SPANS)).alias("live"))


def owner_specific(candidates: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """Hashes (``secret``) that at most so many distinct owners and repositories share."""
    uses = candidates.select("secret", "owner", "repository").distinct()
    owners = uses.groupBy("secret", "owner").agg(F.count("*").alias("repositories"))
    counts = owners.groupBy("secret").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    return counts.filter((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).select("secret")


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
