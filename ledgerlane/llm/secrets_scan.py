"""Secrets in texts, weighed by who owns their copies; DataFrame functions alone.

Candidates of three base kinds and of some further kinds are found by patterns. Places follow from
the lengths of the matches and of the text between them. The digest of each candidate's value is
counted by distinct repositories and owners over the whole corpus. A value is

* an example if ``MANY_OWNERS`` owners hold it, or two owners in ``MANY_REPOSITORIES`` repositories;
* live if it is none and looks random, in however many copies or repositories of one owner;
* plain otherwise: a word, a number, a placeholder.

Base spans are always reported; further kinds only where their value is live. Values are kept and
joined as 128-bit digests and never stored in clear.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import spare, stored

MANY_OWNERS = 4
MANY_REPOSITORIES = 50
SALTS = 16  # ways a value or a row that fills a large part of the table is split
REDACTED = "[secret]"


@dataclass(frozen=True)
class Kind:
    """A pattern whose first group is the value; matches of fewer characters are dropped."""

    name: str
    pattern: str
    least_value: int
    base: bool = False


# Fixed patterns: the three base kinds first, in the order that breaks ties between equal starts.
KINDS = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, True),
    Kind("access", r"(AKIA[A-Z0-9]+)", 20, True),
    Kind("hex", r"([0-9a-f]+)", 24, True),
    Kind("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----([A-Za-z0-9+/=\s]+)", 24),
    Kind("jwt", r"\b(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 26),
    Kind("login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/:@]{6,128})@", 6),
    Kind("vendor", r"\b((?:gh[pousr]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,})", 20),
)
# Short runs of digits and letters a to f are everywhere: for speed the scan itself asks for 24.
# Such runs are whole runs either way, so the spans are the same.
_SCANNED = {"hex": r"([0-9a-f]{24,})", "access": r"(AKIA[A-Z0-9]{16,})"}
_HINT = (
    r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
    r"|-----BEGIN |\beyJ|://[^\s/:@]{1,64}:|\b(?:gh[pousr]_|xox[abprs]-|sk_live_|AIza)"
)


def _found(text: Column, order: int, kind: Kind) -> Column:
    """Matches of one kind in order: kind, number, lengths before and of each, value."""
    pattern = F.lit(_SCANNED.get(kind.name, kind.pattern))
    gaps = F.split(text, _SCANNED.get(kind.name, kind.pattern), -1)
    joined = F.arrays_zip(
        F.transform(gaps, F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("size"),
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("value"),
    )
    return F.transform(
        F.filter(joined, lambda x: x["size"].isNotNull()),
        lambda x, k: F.struct(
            F.lit(order).alias("kind"), k.alias("number"), x["gap"].alias("gap"), x["size"].alias("size"),
            x["value"].alias("value"),
        ),
    )


def _mark() -> Column:
    """A 128-bit digest of a row's id and text, by which spans find their rows again."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col("text"), F.lit(""))).cast("binary"))


def _salted(few: DataFrame, salt: str) -> DataFrame:
    """One row for each salt, to meet rows that were dealt over the salts."""
    return few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def candidates(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Per document (row) and match: row, doc_id, mark, kind, start, end, digest, random, owner, repository.

    Rows without a match stay once, with a null kind. Null texts are empty. ``mark`` is null where a text
    has nothing that a pattern could start with. ``random``: the value looks random.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    nothing = F.array().cast("array<struct<kind:int,number:int,gap:int,size:int,value:string>>")
    every = F.concat(*[_found(F.col("text"), k, kind) for k, kind in enumerate(KINDS)])
    rows = (
        documents.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
            F.when(F.col("text").rlike(_HINT), _mark()).alias("mark"),
            F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"),
            text.alias("text"),
        )
        .withColumn("found", F.when(F.col("mark").isNotNull(), every).otherwise(nothing))
        .select("row", "doc_id", "mark", "owner", "repository", F.explode_outer("found").alias("found"))
        .select("row", "doc_id", "mark", "owner", "repository", "found.*")
    )
    before = Window.partitionBy("row", "kind").orderBy("number")
    end = F.sum(F.col("gap") + F.col("size")).over(before).cast("int")
    least = F.element_at(F.array(*[F.lit(kind.least_value) for kind in KINDS]), F.col("kind") + 1)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    kept = F.coalesce(F.length("value") >= least, F.lit(False))
    # A dropped match must not take its document with it: its row stays without a kind.
    return placed.select(
        "row", "doc_id", "mark", "owner", "repository",
        *[F.when(kept, F.col(c)).alias(c) for c in ("kind", "start", "end")],
        F.when(kept, F.md5(F.col("value").cast("binary"))).alias("digest"),
        F.when(kept, _random_looking(F.col("value"))).alias("random"),
    )


def _random_looking(value: Column) -> Column:
    """Different characters for two thirds of the length, or eight; no long run of one character.

    Also a digit, or at least twenty characters with letters of both cases.
    """
    different, length = F.size(F.array_distinct(F.split(value, ""))), F.length(value)
    varied = (different >= 8) | (different * 3 >= length * 2)
    mixed = value.rlike("[0-9]") | ((length >= 20) & value.rlike("[a-z]") & value.rlike("[A-Z]"))
    return varied & mixed & ~value.rlike(r"(.)\1{5}") & ~value.rlike("(?i)example|xxxx|1234567|placeholder")


def ownership(found: DataFrame) -> DataFrame:
    """Per digest of a value: distinct owners and repositories, and whether it is an example or live."""
    # Pairs are made distinct first: a value with a third of all rows is one row a task and owner.
    held = found.where("kind is not null").groupBy("digest", "owner", "repository").agg(F.any_value("random").alias("random"))
    by_owner = held.groupBy("digest", "owner").agg(
        F.count("repository").alias("repositories"), F.any_value("random").alias("random")
    )
    counted = by_owner.groupBy("digest").agg(
        F.count("owner").alias("owners"), F.sum("repositories").alias("repositories"),
        F.any_value("random").alias("random"),
    )
    spread = (F.col("owners") >= 2) & (F.col("repositories") >= MANY_REPOSITORIES)
    example = (F.col("owners") >= MANY_OWNERS) | spread
    return counted.select("digest", "owners", "repositories", example.alias("example"), (~example & F.col("random")).alias("live"))


def weighed(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """All candidates with owners, repositories, example and live; rows without any have a null kind."""
    found = stored(candidates(documents, owner, repository), "secret-candidates")
    # Most rows have no candidate; they would all meet in one task of the join.
    dealt = found.where("digest is not null").withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    matched = dealt.join(_salted(ownership(found), "salt"), ["digest", "salt"], "left").drop("salt")
    rest = found.where("digest is null").withColumns({
        "owners": F.lit(None).cast("long"), "repositories": F.lit(None).cast("long"),
        "example": F.lit(None).cast("boolean"), "live": F.lit(None).cast("boolean"),
    })
    return matched.unionByName(rest)


def scan(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, n_plain.

    A document without a match, with a null or an empty text has zero counts, the hash of an empty
    string and an empty list; an empty table has no rows. Repeated rows are reported as often as they
    occur. Texts are scanned whole, however long. Rows of a null owner or repository hold values of no
    owner or repository, which are live if they look random. Further columns are not read.
    """
    base = sum(kind.base for kind in KINDS)
    name = F.element_at(F.array(*[F.lit(kind.name) for kind in KINDS]), F.col("kind") + 1)
    span = F.struct(
        "start", "kind", F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string")).alias("said")
    )
    of_base, live = F.col("kind") < base, F.coalesce("live", F.lit(False))
    said = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda x: x["said"]), ",")
    return (
        weighed(documents, owner, repository)
        .groupBy("row", "doc_id")
        .agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k].name}") for k in range(base)],
            F.sha2(said(F.collect_list(F.when(of_base, span))), 256).alias("base_sha256"),
            said(F.collect_list(F.when(of_base | live, span))).alias("spans"),
            F.count_if(F.col("kind").isNotNull() & live).alias("n_live"),
            F.count_if(F.coalesce("example", F.lit(False))).alias("n_example"),
            F.count_if(F.col("kind").isNotNull() & ~live & ~F.coalesce("example", F.lit(False))).alias("n_plain"),
        )
        .drop("row")
    )


def redacted(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """The documents, with every live value's span replaced by ``REDACTED`` and n_chars to match.

    Overlapping spans are replaced as one. Copied examples stay as they are. Rows and columns stay
    as they came, whatever the columns' names, rows without a live secret unchanged. Texts that no
    pattern could start in are not moved; the others meet their spans by a digest of id and text.
    """
    mark, salt, held, cut = spare(documents.columns, "mark", "salt", "spans", "cut")
    live = weighed(documents, owner, repository).where("live")
    order = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        live.withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1))
        .withColumn("island", F.sum("new").over(order))
        .groupBy("row", "mark", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("row", "mark").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(held))
        .groupBy("mark").agg(F.any_value(held).alias(held))  # equal texts have equal spans
        .withColumnRenamed("mark", mark)
    )
    text, hinted = F.col("text"), F.coalesce(F.col("text").rlike(_HINT), F.lit(False))
    ends = F.concat(F.array(F.lit(0)), F.col(f"{held}.end"))
    begins = F.concat(F.col(f"{held}.start"), F.array(F.length(text)))
    between = F.transform(F.arrays_zip(ends.alias("a"), begins.alias("b")), lambda x: F.substring(text, x["a"] + 1, x["b"] - x["a"]))
    kept = F.col(held).isNull()
    columns = {name: F.col(f"`{name}`") for name in documents.columns}
    replaced = {"text": F.col(cut)}
    if "n_chars" in columns:
        replaced["n_chars"] = F.when(kept, F.col("n_chars")).otherwise(F.length(cut)).cast(documents.schema["n_chars"].dataType)
    dealt = documents.where(hinted).withColumn(mark, _mark()).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    met = dealt.join(_salted(spans, salt), [mark, salt], "left")
    changed = met.withColumn(cut, F.when(kept, text).otherwise(F.array_join(between, REDACTED))).select(
        *[replaced.get(name, column).alias(name) for name, column in columns.items()]
    )
    return documents.where(~hinted).unionAll(changed)
