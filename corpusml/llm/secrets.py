"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three base kinds are found by pattern in every whole text: ``assign`` (a keyword with a value),
``access`` (access key ids) and ``hex`` (long hexadecimal runs). The scan also collects ``bare``
candidates, long tokens of mixed letters and digits without any keyword. The value of every
candidate is hashed and the hashes are counted over the whole corpus by distinct owners and
distinct repositories. A value of ``COPIED_OWNERS`` owners or ``COPIED_REPOSITORIES`` repositories
and more is a copied example, whichever comes first; a value of one owner in fewer repositories is
specific to it. A value of two owners in fewer repositories is undecided: neither copied nor live, its
base spans stay and its bare tokens are no spans. A bare token becomes a span only if it is specific
to one owner and looks live (enough different characters, no placeholder word, no overlap with a base
span).

Positions are code points. ``split`` and ``regexp_extract_all`` find the same matches, so the
lengths of the pieces and of the matches add up to the offset of each match. The patterns are run
to the end only on texts in which they occur at all. Spans without their text go to a table in
the shared folder; counting and joining read that table. Counting combines before every shuffle
and the join on the hash is an equi-join that adaptive execution can split, so a value that a
third of all documents hold is no problem.

Null and empty texts have no spans; a null owner counts as an owner of its own, and every row with a
null repository as a repository of its own; repeated rows
are separate rows of the result; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.functions.text import let
from corpusml.storage import materialize

# The patterns of the base kinds and the least length of what counts.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
# A run of 16 and more is the whole run, so the look-behind only skips useless starts.
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
BARE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|xxxx|your[_-]"

KINDS = ("assign", "access", "hex", "bare")
#: Owners that make a value a widely copied example.
COPIED_OWNERS = 3
#: Repositories, of all owners together, that do the same: one owner may keep its own value in a few places.
COPIED_REPOSITORIES = 10
#: Different characters that a live-looking value has at least.
LIVE_CHARACTERS = 8

#: Entries that :func:`running` folds one by one.
BLOCK = 128

_SPAN = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running fold of an array of longs, every entry with all before it; ``step`` is associative.

    An array that grows entry by entry is copied each time. So entries are folded in blocks of ``BLOCK``, then the last
    entries of the blocks, and what lies before a block is added to each of its entries.
    """

    def fold(a: Column) -> Column:
        def add(seen: Column, value: Column) -> Column:
            last = F.get(seen, F.size(seen) - 1)
            return F.concat(seen, F.array(F.when(F.size(seen) > 0, step(last, value)).otherwise(value)))

        return F.aggregate(a, F.array().cast("array<bigint>"), add)

    def blocks(a: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(a) / BLOCK).cast("int") - 1, F.lit(0)))
        return F.transform(numbers, lambda b: fold(F.slice(a, b * BLOCK + 1, F.lit(BLOCK))))

    def joined_blocks(parts: Column) -> Column:
        lasts = F.transform(parts, lambda p: F.get(p, F.size(p) - 1))
        return let(fold(lasts), lambda before: F.flatten(F.transform(
            parts, lambda p, i: F.when(i == 0, p).otherwise(F.transform(p, lambda v: step(F.get(before, i - 1), v)))
        )))

    return let(values, lambda a: let(blocks(a), joined_blocks))


def apart(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of the ``others``, by one pass over both in order of their starts."""
    none = F.lit(2**62)

    def events(side: Column, number: int) -> Column:
        return F.transform(side, lambda s, i: F.struct(s["start"].alias("at"), F.lit(number).alias("side"), s["end"].alias("reach"), i.alias("i")))

    def kept(e: Column) -> Column:
        reached = running(F.transform(e, lambda x: F.when(x["side"] == 0, x["reach"]).otherwise(F.lit(0).cast("long"))), F.greatest)
        following = F.reverse(running(F.transform(F.reverse(e), lambda x: F.when(x["side"] == 0, x["at"]).otherwise(none)), F.least))
        rows = F.arrays_zip(e.alias("x"), reached.alias("reached"), following.alias("following"))
        free = F.filter(rows, lambda r: (r["x"]["side"] == 1) & (r["reached"] <= r["x"]["at"]) & (r["following"] >= r["x"]["reach"]))
        return F.transform(free, lambda r: F.get(spans, r["x"]["i"]))

    both = F.array_sort(F.concat(events(others, 0), events(spans, 1)))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), let(both, kept)).otherwise(spans)


def spans_of(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of ``(start, end, kind, value)``."""
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(pieces, lambda piece: F.length(piece).cast("long"))
    sizes = F.transform(whole, lambda match: F.length(match).cast("long"))
    steps = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), values.alias("value"))
    # One element more than matches: the last piece has none.
    steps = F.filter(steps, lambda step: step["size"].isNotNull())

    def placed(s: Column) -> Column:
        ends = running(F.transform(s, lambda step: step["gap"] + step["size"]), lambda x, y: x + y)
        return F.zip_with(s, ends, lambda step, end: F.struct(
            (end - step["size"]).alias("start"), end.alias("end"), F.lit(kind).alias("kind"), step["value"].alias("value"),
        )).cast(_SPAN)

    found = let(steps, placed)
    kept = F.filter(found, lambda span: F.length(span["value"]) >= least) if least else found
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(_SPAN))


def _live(value: Column) -> Column:
    characters = F.size(F.array_distinct(F.split(value, "")))
    return (characters >= LIVE_CHARACTERS) & ~value.rlike(PLACEHOLDER)


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, idx: str, text: str, owner: str, repository: str) -> DataFrame:
    """The spans of all documents, stored: ``(row, doc_id, owner, repository, text_hash, base, bare)``."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        spans_of(body, ASSIGN, 0, group=1, least=ASSIGN_LENGTH), spans_of(body, ACCESS, 1), spans_of(body, HEX, 2)
    )
    rows = docs.select(
        F.col(idx).alias("doc_id"), F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"),
        F.xxhash64(text).alias("text_hash"), base.alias("base"), spans_of(body, BARE, 3).alias("bare"),
    )
    looks = F.filter("bare", lambda b: _mixed(b["value"]) & _live(b["value"]))
    free = let(looks, lambda bare: apart(bare, F.col("base")))
    return materialize(rows.withColumn("bare", free).withColumn("row", F.monotonically_increasing_id()), "secret-spans")


def ownership(values: DataFrame) -> DataFrame:
    """``(digest, owners, repositories)`` of every candidate value of ``(digest, owner, repository)``."""
    per_owner = values.groupBy("digest", "owner", "repository").agg(F.lit(1).alias("_one")).groupBy("digest", "owner").agg(F.count("*").alias("_repositories"))
    return per_owner.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("_repositories").alias("repositories"))


def scan(docs: DataFrame, idx: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``(row, doc_id, text_hash, base, spans, live, copied)`` for every row of ``docs``.

    ``base`` and ``spans`` are arrays of ``(start, end, kind, value)``; ``live`` counts the spans whose
    value is specific to one owner and looks live, ``copied`` those whose value is a copied example.
    """
    found = candidates(docs, idx, text, owner, repository)
    place = F.coalesce("repository", F.concat(F.lit("row "), F.col("row").cast("string")))
    spans = found.select("row", "owner", place.alias("repository"), F.explode(F.concat("base", "bare")).alias("span"))
    spans = spans.withColumn("digest", F.sha2(F.col("span.value"), 256))
    judged = spans.join(ownership(spans.select("digest", "owner", "repository")), "digest")
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repositories") >= COPIED_REPOSITORIES)
    single = (F.col("owners") == 1) & ~copied & _live(F.col("span.value"))
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when((F.col("span.kind") == 3) & single, F.col("span"))).alias("_added"),
        F.sum(single.cast("long")).alias("live"),
        F.sum(copied.cast("long")).alias("copied"),
    )
    none = F.array().cast(_SPAN)
    whole = found.select("row", "doc_id", "text_hash", "base").join(per_row, "row", "left")
    return whole.select(
        "row", "doc_id", "text_hash", "base", F.concat("base", F.coalesce("_added", none)).alias("spans"),
        F.coalesce("live", F.lit(0)).cast("long").alias("live"), F.coalesce("copied", F.lit(0)).cast("long").alias("copied"),
    )


def digest_columns(scanned: DataFrame) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), "live", "copied",
    )


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans become one."""
    # Empty spans array: the text stays. Each span cuts what lies before the furthest end so far.
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    zero = F.lit(0).cast("long")
    cut = F.aggregate(
        ordered, F.struct(zero.alias("at"), F.lit("").alias("out")),
        lambda seen, s: F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(s["start"] < seen["at"], seen["out"]).otherwise(
                F.concat(seen["out"], F.substring(text, (seen["at"] + 1).cast("int"), (s["start"] - seen["at"]).cast("int")), F.lit(mark))
            ).alias("out"),
        ),
        lambda seen: F.concat(seen["out"], F.substring(text, (seen["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def _sql_spans(pattern: str, kind: int, group: int = 0, least: int = 0) -> str:
    quoted = pattern.replace("'", "''")
    whole = f"regexp_extract_all(body, '{quoted}')"
    values = f"regexp_extract_all(body, '{quoted}', {group})" if group else whole
    # Lengths of pieces and matches before the i-th match give its offset.
    return f"""
    SELECT doc_id, owner, gap + before AS "start", gap + before + length(match) AS "end", {kind} AS kind, value
    FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS gap,
                 coalesce(sum(length(match)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM (SELECT doc_id, owner, unnest(range(len(matches))) AS i, unnest(matches) AS match, unnest(vals) AS value, unnest(pieces[:len(matches)]) AS piece
                FROM (SELECT doc_id, owner, {whole} AS matches, {values} AS vals, string_split_regex(body, '{quoted}') AS pieces FROM docs)))
    WHERE length(value) >= {least}"""


OP_SQL = f"""
WITH docs AS (SELECT doc_id, source AS owner, coalesce(text, '') AS body FROM documents),
base AS ({_sql_spans(ASSIGN, 0, 1, ASSIGN_LENGTH)} UNION ALL {_sql_spans(ACCESS, 1)} UNION ALL {_sql_spans(HEX.split(")", 1)[1], 2)}),
loose AS (
  SELECT * FROM ({_sql_spans(BARE.split(")", 1)[1], 3)}) b
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND len(list_distinct(string_split(value, ''))) >= {LIVE_CHARACTERS} AND NOT regexp_matches(value, '{PLACEHOLDER}')
    AND NOT EXISTS (SELECT 1 FROM base s WHERE s.doc_id = b.doc_id AND s."start" < b."end" AND b."start" < s."end")),
every AS (SELECT *, len(list_distinct(string_split(value, ''))) >= {LIVE_CHARACTERS} AND NOT regexp_matches(value, '{PLACEHOLDER}') AS looks FROM (SELECT * FROM base UNION ALL SELECT * FROM loose)),
owned AS (SELECT value, count(DISTINCT coalesce(owner, chr(0))) AS owners, count(DISTINCT (coalesce(owner, chr(0)), doc_id)) AS repositories FROM every GROUP BY value),
spread AS (SELECT value, owners, owners >= {COPIED_OWNERS} OR repositories >= {COPIED_REPOSITORIES} AS is_copied FROM owned),
judged AS (SELECT every.*, is_copied, owners = 1 AND NOT is_copied AND looks AS single FROM every JOIN spread USING (value)),
named AS (SELECT *, ['assign','access','hex','bare'][kind + 1] || ':' || "start" || ':' || "end" AS name FROM judged),
rolled AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(name, ',' ORDER BY "start", kind) FILTER (kind < 3) AS base,
         string_agg(name, ',' ORDER BY "start", kind) FILTER (kind < 3 OR single) AS spans,
         count(*) FILTER (single) AS live, count(*) FILTER (is_copied) AS copied
  FROM named GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(live, 0) AS live, coalesce(copied, 0) AS copied
FROM docs LEFT JOIN rolled USING (doc_id)"""
