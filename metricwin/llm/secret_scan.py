"""Secrets in texts, judged by how many owners of the corpus hold the same value.

Only DataFrame functions run here. A pattern's matches and the stretches between them come from
``regexp_extract_all`` and ``split``; one row per match and a running sum give positions in time
linear in the matches. Everything is keyed by the text's SHA-256, so copies of a text are scanned
where they lie and counted once; values are compared by hash only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwin.llm.common import table

# The kinds in the order they are listed, their patterns, the group that holds the
# value and the characters it must have.
KINDS = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: Added kinds: what the corpus says of the value at a span.
VERDICTS = ("live", "example", "placeholder")
NAMES = tuple(k[0] for k in KINDS) + VERDICTS
#: To find texts that may hold a kind at all; a run that is long enough starts where any run does.
SIEVES = (KINDS[0][1], r"AKIA[A-Z0-9]{12}", r"[0-9a-f]{32}")
#: Runs that are too short need no row, and leaving them out moves no other match.
SCANS = (KINDS[0][1], r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}")
#: A whole access key id.
ACCESS_ID = r"\AAKIA[A-Z2-7]{16}\z"
#: An assigned value without a digit is no mere word from this length on, or if its case is mixed.
NO_WORD = 12


@dataclass(frozen=True)
class Scan:
    """``rows``: the input's columns asked for and ``key``, null where nothing was found.
    ``spans``: key, start, kind, end of every span of each text once, verdicts included."""

    rows: DataFrame
    spans: DataFrame


def _found(text: Column, kind: int) -> Column:
    """Of one kind: nth, characters before it since the last match, its own, and the value."""
    group = F.lit(KINDS[kind][2])
    pattern = F.lit(SCANS[kind])
    zipped = F.arrays_zip(
        F.split(text, SCANS[kind], -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, group).alias("value"),
    )
    rows = F.transform(
        F.filter(zipped, lambda x: x["whole"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["whole"]).cast("long").alias("size"),
            x["value"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,nth:int,gap:bigint,size:bigint,value:string>>")
    return F.when(text.rlike(SIEVES[kind]), rows).otherwise(none)


def _text_key(text: Column) -> Column:
    """The text's hash if any kind may be in it, else null."""
    may = text.rlike(SIEVES[0]) | text.rlike(SIEVES[1]) | text.rlike(SIEVES[2])
    return F.when(may, F.sha2(text, 256))


def may_be_secret(kind: Column, value: Column) -> Column:
    """Key ids and hex runs by their form alone; values with a digit; and assigned values without
    one that are long or mix upper and lower case."""
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]")
    return (
        value.rlike("[0-9]")
        | (kind == 2)
        | ((kind == 1) & value.rlike(ACCESS_ID))
        | ((kind == 0) & (mixed | (F.length(value) >= NO_WORD)))
    )


def scan(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    min_owners: int = 3,
    min_distinct: int = 6,
) -> Scan:
    """Find every kind in every whole ``text`` and judge each value by the whole corpus.

    A value that ``min_owners`` distinct owners or more hold is a widely copied ``example``. One
    that fewer hold is ``live`` if it has ``min_distinct`` different characters and passes
    ``may_be_secret``, else a ``placeholder``. Null owners or repositories count as one of
    their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(owner, F.lit("")).alias("owner"),
        F.coalesce(repository, F.lit("")).alias("repository"),
        text.alias("text"),
    )
    found = F.concat(*[_found(F.col("text"), k) for k in range(len(KINDS))])
    rows = rows.select(
        "doc_id", "owner", "repository", _text_key(F.col("text")).alias("key"), found.alias("found")
    )
    rows = table(rows, "secret-rows")
    hits = rows.where("key is not null")
    once = (
        hits.select("key", F.inline("found"))
        .groupBy("key", "kind", "nth")
        .agg(F.min("gap").alias("gap"), F.min("size").alias("size"), F.min("value").alias("value"))
    )
    so_far = (
        Window.partitionBy("key", "kind")
        .orderBy("nth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    enough = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    distinct = F.size(F.array_distinct(F.split("value", "")))
    looks_live = (distinct >= min_distinct) & may_be_secret(F.col("kind"), F.col("value"))
    placed = (
        once.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
        .where(F.length("value") >= enough)
        .select(
            "key",
            "kind",
            (F.col("end") - F.col("size")).alias("start"),
            "end",
            F.length("value").cast("long").alias("width"),
            looks_live.alias("looks_live"),
            F.sha2("value", 256).alias("candidate"),
        )
    )
    placed = table(placed, "secret-spans")
    held = hits.select("key", "owner", "repository").distinct()
    spread = (
        placed.select("key", "candidate")
        .distinct()
        .join(held, "key")
        .groupBy("candidate")
        .agg(
            F.countDistinct("owner").alias("owners"),
            F.countDistinct("repository").alias("repositories"),
        )
    )
    judged = placed.join(spread, "candidate")
    verdict = (
        F.when(F.col("owners") >= min_owners, F.lit(len(KINDS) + VERDICTS.index("example")))
        .when(F.col("looks_live"), F.lit(len(KINDS) + VERDICTS.index("live")))
        .otherwise(F.lit(len(KINDS) + VERDICTS.index("placeholder")))
    )
    both = F.array(
        F.struct("start", "kind", "end"),
        F.struct(
            (F.col("end") - F.col("width")).alias("start"), verdict.alias("kind"), F.col("end")
        ),
    )
    spans = judged.select("key", "owners", "repositories", F.inline(both))
    return Scan(rows.drop("found", "owner", "repository"), table(spans, "secret-judged"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def secret_spans(
    docs: DataFrame, owner: Column, repository: Column, min_owners: int = 3
) -> DataFrame:
    """One row for each row of ``doc_id, text``: counts and spans of the kinds, and verdicts.

    n_assign, n_access, n_hex; base_sha256 of ``kind:start:end`` by start, then kind, with commas;
    spans, the same with the verdicts at the values' places; max_owners and max_repositories, how
    many hold the most widely copied value of the text. Positions are code points, ends exclusive.
    A null text counts as empty; a text without secrets has zeros and empty lists; repeated rows
    stay repeated; a null doc_id stays null; other columns are ignored.
    """
    found = scan(docs, owner, repository, min_owners)
    lists = found.spans.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", "kind", "end"))).alias("all"),
        F.max("owners").alias("max_owners"),
        F.max("repositories").alias("max_repositories"),
    )
    hits = found.rows.where("key is not null").join(lists, "key", "left").drop("key")
    kind = "array<struct<start:bigint,kind:int,end:bigint>>"
    clean = found.rows.where("key is null").select(
        "doc_id",
        F.lit(None).cast(kind).alias("all"),
        F.lit(None).cast("long").alias("max_owners"),
        F.lit(None).cast("long").alias("max_repositories"),
    )
    spans = F.coalesce(F.col("all"), F.array().cast(kind))
    rows = hits.unionByName(clean).withColumn("all", spans)

    def count(k: int) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == k)).cast("long")

    base = F.filter("all", lambda s: s["kind"] < len(KINDS))
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        F.coalesce("max_owners", F.lit(0)).cast("long").alias("max_owners"),
        F.coalesce("max_repositories", F.lit(0)).cast("long").alias("max_repositories"),
    )


#: Code points of a block of a text that is cut; places are found within a block.
BLOCK = 4096


def _cuts_by_block(live: DataFrame) -> DataFrame:
    """``key, cuts``: block number -> stretches to cut there, in order, as begin, end, opens.

    Overlapping spans are one stretch; one that reaches over a block's end is cut in each block
    and opens in its first.
    """
    by_start = Window.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        live.select("key", "start", "end")
        .distinct()
        .withColumn("opens", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
        .withColumn("run", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    first, last = F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK)
    parts = runs.select("key", "start", "end", F.explode(F.sequence(first, last)).alias("block"))
    base = F.col("block") * BLOCK
    cut = F.struct(
        F.greatest(F.col("start") - base, F.lit(0)).cast("int").alias("begin"),
        F.least(F.col("end") - base, F.lit(BLOCK)).cast("int").alias("end"),
        (F.col("start") >= base).alias("opens"),
    )
    blocks = parts.groupBy("key", "block").agg(F.sort_array(F.collect_list(cut)).alias("cuts"))
    entries = F.collect_list(F.struct(F.col("block").cast("int"), F.col("cuts")))
    return blocks.groupBy("key").agg(F.map_from_entries(entries).alias("cuts"))


def _without(block: Column, cuts: Column, mask: str) -> Column:
    """A block's text with ``mask`` where a cut opens and nothing where it goes on."""
    ends = F.concat(F.array(F.lit(0)), cuts["end"])
    begins = F.concat(cuts["begin"], F.array(F.lit(BLOCK)))
    opens = F.concat(F.array(F.lit(False)), cuts["opens"])
    pieces = F.arrays_zip(ends.alias("a"), begins.alias("b"), opens.alias("opens"))
    kept = F.transform(
        pieces,
        lambda x: F.concat(
            F.when(x["opens"], F.lit(mask)).otherwise(F.lit("")),
            F.substring(block, x["a"] + 1, x["b"] - x["a"]),
        ),
    )
    return F.when(cuts.isNull(), block).otherwise(F.array_join(kept, ""))


def redact(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    min_owners: int = 3,
    mask: str = "[secret]",
) -> DataFrame:
    """``docs`` with every live value in ``text`` replaced by ``mask``; ``n_chars`` follows if there.

    No row is dropped; rows without a live value are returned as they are, whatever their other
    columns are called. Each text is sieved once: the rows are written with the hash of those
    that may hold something, and only these are scanned. A text is cut block by block, in time
    linear in its length and its secrets.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        row.alias("row"),
        _text_key(F.col("text")).alias("key"),
        F.when(F.length("text") > 0, owner).alias("owner"),
        F.when(F.length("text") > 0, repository).alias("repository"),
    )
    rows = table(rows, "secret-sieved")
    hits = rows.where("key is not null")
    scanned = hits.select(F.lit(0).alias("doc_id"), F.col("row.text").alias("text"), "owner", "repository")
    found = scan(scanned, F.col("owner"), F.col("repository"), min_owners)
    live = found.spans.where(F.col("kind") == len(KINDS) + VERDICTS.index("live"))
    text = F.col("row.text")
    blocks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))
    clean = F.array_join(
        F.transform(blocks, lambda b, i: _without(b, F.try_element_at(F.col("cuts"), i), mask)), ""
    )
    joined = hits.join(_cuts_by_block(live), "key", "left")
    joined = joined.withColumn("clean", F.when(F.col("cuts").isNotNull(), clean))
    values = {c: F.col("row")[c] for c in docs.columns}
    changed = dict(values, text=F.coalesce("clean", text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("clean").isNotNull(), F.length("clean").cast(kind)).otherwise(
            values["n_chars"]
        )
    untouched = rows.where("key is null").select(*[v.alias(c) for c, v in values.items()])
    return joined.select(*[v.alias(c) for c, v in changed.items()]).union(untouched)
