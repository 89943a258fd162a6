"""Lines that recur across documents, by a tree of line templates.

All of it is built-in functions. A line is parsed in fixed depth: by its number
of tokens, then by its first two, where tokens with a digit count as a variable
field. The lines of a group, at first a leaf, share one template: at each further
place the token that more than half of the group's documents have there, or else
a variable field. A line follows the template if at least half of these places
agree with it. Lines that don't are a group of their own and vote again, and a
group without such a majority is split at the place of its most frequent token,
until no group can hold a recurring template. Lines that follow none stand for
themselves, with their variable fields.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.decontamination import fingerprint_filter
from ratewise.llm.text import SPACE, free_prefix, let
from ratewise.session import scratch_path

FIELD = "<*>"
_WITH_DIGIT = r"(?<![^ \t\n\x0B\f\r])[^ \t\n\x0B\f\r0-9]*+[0-9][^ \t\n\x0B\f\r]*"


def masked_tokens(line: Column) -> Column:
    """Tokens of a line; those with a digit become a variable field."""
    # Most lines have no digit and no blank but the plain one.
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _WITH_DIGIT, FIELD)).otherwise(line)
    plain = F.when(
        line.rlike(r"[\t\x0B\f\r]"), F.regexp_replace(masked, SPACE, " ")
    ).otherwise(masked)
    return F.array_remove(F.split(plain, " "), "")


def _lines(docs: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """(doc_id, text_hash, line_no, tokens, leaf, line_hash) of lines that are long enough."""
    tokens = F.transform(F.split("text", "\n"), masked_tokens)
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(tokens))
        .withColumnsRenamed({"pos": "line_no", "col": "tokens"})
        .filter(F.size("tokens") >= max(min_tokens, depth))
        .withColumn("leaf", F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)))
        .withColumn("line_hash", F.xxhash64("tokens"))
    )


def leaf_templates(lines: DataFrame, depth: int) -> DataFrame:
    """(leaf, constants): the majority token of each place after the leading ones, or null.

    ``lines`` holds distinct lines (leaf, tokens, n_docs) of leaves with two or
    more of them; each counts with its documents.
    """
    places = lines.select(
        "leaf", "n_docs", F.posexplode(F.slice("tokens", depth + 1, 2**30)).alias("place", "token")
    )
    tokens = places.groupBy("leaf", "place", "token").agg(F.sum("n_docs").alias("n"))
    best = tokens.groupBy("leaf", "place").agg(
        F.max(F.struct("n", "token")).alias("top"), F.sum("n").alias("total")
    )
    constant = F.when(F.col("top.n") * 2 > F.col("total"), F.col("top.token"))
    return best.groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct("place", constant.alias("token")))).alias("constants")
    )


def _agreeing(rest: Column, constants: Column) -> Column:
    """Number of places at which a line has the token of the template."""
    same = F.zip_with(rest, constants, lambda t, c: F.coalesce(t == c["token"], F.lit(False)))
    return F.size(F.filter(same, lambda s: s))


def _one_vote(members: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(line_hash, n_docs, general) of the lines that follow the one template of their leaf."""
    rest = F.slice("tokens", depth + 1, 2**30)
    fitted = members.join(leaf_templates(members, depth), "leaf")
    return fitted.filter(
        _agreeing(rest, F.col("constants")) >= similarity * (F.size("tokens") - depth)
    ).select("line_hash", "n_docs", F.xxhash64("leaf", F.col("constants.token")).alias("general"))


def _votes_in_rounds(
    members: DataFrame, depth: int, similarity: float, min_docs: int
) -> DataFrame:
    """(line_hash, n_docs, general) of the lines that follow a template of a group of their leaf.

    Each round settles a group, takes the followers of its template out of it
    or splits it at one place: one group for each token of at least ``min_docs``
    documents there, one for the other lines. A place at which a group was split
    never splits its parts again, so the rounds end by themselves. A group goes on only
    if ``similarity`` of its places have a token that could be a majority of
    ``min_docs`` documents.
    """
    spark = members.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rest = F.slice("tokens", depth + 1, 2**30).alias("rest")
    active = members.select(F.col("leaf").alias("grp"), "line_hash", rest, "n_docs")
    found = []
    while True:
        # A token of fewer documents is no majority of min_docs, and splits no group.
        votes = written(
            active.select("grp", "n_docs", F.posexplode("rest").alias("place", "token"))
            .groupBy("grp", "place", "token")
            .agg(F.sum("n_docs").alias("n"))
            .filter(F.col("n") * 2 > min_docs),
            "line-votes",
        )
        tops = (
            votes.groupBy("grp", "place")
            .agg(F.max(F.struct("n", "token")).alias("top"))
            .groupBy("grp")
            .agg(F.collect_list(F.struct("place", "top.n", "top.token")).alias("tops"))
        )
        # Lines of a group have equally many places, so each place has all documents.
        whole = active.groupBy("grp").agg(
            F.sum("n_docs").alias("total"), F.first(F.size("rest")).alias("width")
        )
        total = F.col("total")
        splits = F.filter("tops", lambda t: (t["n"] * 2 <= total) & (t["n"] >= min_docs))
        best = F.array_max(F.transform(splits, lambda t: F.struct(t["n"], (-t["place"]).alias("at"))))
        groups = written(
            whole.filter(total >= min_docs)
            .join(tops, "grp", "left")
            .filter(F.coalesce(F.size("tops"), F.lit(0)) >= similarity * F.col("width"))
            .select(
                "grp",
                "total",
                F.sort_array(F.filter("tops", lambda t: t["n"] * 2 > total)).alias("constants"),
                (-best["at"]).alias("place"),
            ),
            "line-votes-by-group",
        )
        if groups.isEmpty():
            break
        same = F.size(
            F.filter("constants", lambda c: F.get(F.col("rest"), c["place"]) == c["token"])
        )
        agrees = F.coalesce(same, F.lit(0)) >= similarity * F.size("rest")
        fitted = written(
            active.join(groups, "grp").select(
                "grp", "line_hash", "rest", "n_docs", "total", "place", agrees.alias("follows"),
                F.xxhash64("grp", F.col("constants.token")).alias("general"),
            ),
            "fitted-lines",
        )
        # A template is taken if it recurs and has a fair part of its group, or nothing splits it.
        following = fitted.groupBy("grp").agg(
            F.sum(F.when(F.col("follows"), F.col("n_docs"))).alias("n"),
            F.first("total").alias("total"),
            F.first("place").alias("place"),
        )
        taken = (F.col("n") >= min_docs) & (
            (F.col("n") * 4 >= F.col("total")) | F.col("place").isNull()
        )
        verdict = written(
            following.select("grp", "place", F.coalesce(taken, F.lit(False)).alias("taken")).filter(
                F.col("taken") | F.col("place").isNotNull()
            ),
            "group-verdicts",
        )
        decided = fitted.drop("place", "total").join(verdict, "grp")
        found.append(
            written(
                decided.filter("taken AND follows").select("line_hash", "n_docs", "general"),
                "followers",
            )
        )
        others = decided.filter("taken AND NOT follows").select(
            F.xxhash64("grp", F.lit(-1)).alias("grp"), "line_hash", "rest", "n_docs"
        )
        frequent = (
            votes.filter(F.col("n") >= min_docs)
            .join(verdict.filter("NOT taken"), ["grp", "place"])
            .select("grp", F.col("token").alias("at"), F.xxhash64("token").alias("part"))
        )
        parts = (
            decided.filter("NOT taken")
            .withColumn("at", F.get("rest", "place"))
            .join(frequent, ["grp", "at"], "left")
            .select(F.xxhash64("grp", "place", "part").alias("grp"), "line_hash", "rest", "n_docs")
        )
        active = written(others.union(parts), "line-groups")
    if not found:
        return spark.createDataFrame([], "line_hash bigint, n_docs bigint, general bigint")
    return reduce(DataFrame.union, found)


def recurring_lines(
    docs: DataFrame, min_docs: int = 5, min_tokens: int = 3, depth: int = 2, similarity: float = 0.5,
    rounds: bool = True,
) -> DataFrame:
    """(doc_id, text_hash, line_no, template) of lines to drop.

    A template of at least ``min_docs`` documents recurs; it is dropped
    everywhere but at its first occurrence (smallest doc_id, text, line), so
    that no content is lost. Without ``rounds`` a leaf votes once, for one
    template.
    """
    spark = docs.sparkSession
    every = _lines(docs, min_tokens, depth)
    path = scratch_path(spark, "lines")
    every.drop("tokens").write.parquet(path)  # hashes alone; few lines are needed again
    lines = spark.read.parquet(path)

    # A line counts once a document, and copies of a line are one row from here.
    distinct = (
        lines.select("leaf", "line_hash", "doc_id", "text_hash")
        .distinct()
        .groupBy("leaf", "line_hash")
        .agg(F.count("*").alias("n_docs"))
    )
    path = scratch_path(spark, "distinct-lines")
    distinct.write.parquet(path)
    distinct = spark.read.parquet(path)
    # Leaves that can hold a recurring template of different lines.
    mixed = (
        distinct.groupBy("leaf")
        .agg(F.count("*").alias("kinds"), F.sum("n_docs").alias("n"))
        .filter((F.col("kinds") > 1) & (F.col("n") >= min_docs))
        .select("leaf")
    )
    path = scratch_path(spark, "mixed-leaves")
    mixed.write.parquet(path)
    mixed = spark.read.parquet(path)
    maybe = fingerprint_filter(mixed.select(F.col("leaf").alias("fp")))
    path = scratch_path(spark, "mixed-lines")
    (
        every.filter(F.size("tokens") > depth)
        .filter(maybe(F.col("leaf")))
        .join(mixed, "leaf")
        .groupBy("leaf", "line_hash")
        .agg(F.first("tokens").alias("tokens"))
        .join(distinct, ["leaf", "line_hash"])
        .write.parquet(path)
    )
    members = spark.read.parquet(path)
    following = (
        _votes_in_rounds(members, depth, similarity, min_docs)
        if rounds
        else _one_vote(members, depth, similarity)
    )

    # A line that follows none is its own template, so it recurs by its own documents.
    own = distinct.filter(F.col("n_docs") >= min_docs).select("line_hash", "n_docs")
    own = own.join(following, "line_hash", "left_anti").withColumn("template", F.col("line_hash"))
    path = scratch_path(spark, "named-lines")
    following.withColumnRenamed("general", "template").union(own).write.parquet(path)
    named = spark.read.parquet(path)
    # The sum is an upper bound of the template's documents; the rest can't recur.
    possible = (
        named.groupBy("template").agg(F.sum("n_docs").alias("n")).filter(F.col("n") >= min_docs)
    )
    path = scratch_path(spark, "line-templates")
    named.join(possible.select("template"), "template").select(
        "line_hash", "template"
    ).write.parquet(path)
    wanted = spark.read.parquet(path)
    maybe = fingerprint_filter(wanted.select(F.col("line_hash").alias("fp")))
    path = scratch_path(spark, "placed-lines")
    (
        lines.select("doc_id", "text_hash", "line_no", "line_hash")
        .filter(maybe(F.col("line_hash")))
        .join(wanted, "line_hash")
        .drop("line_hash")
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    where = F.struct("doc_id", "text_hash", "line_no")
    per_doc = placed.groupBy("template", "doc_id", "text_hash").agg(F.min("line_no").alias("line_no"))
    recurring = (
        per_doc.groupBy("template")
        .agg(F.count("*").alias("n"), F.min(where).alias("first"))
        .filter(F.col("n") >= min_docs)
    )
    path = scratch_path(spark, "recurring-templates")
    recurring.select("template", "first").write.parquet(path)
    # Read anew, so that the join starts from plain rows and a frequent one can be split.
    recurring = spark.read.parquet(path)
    return (
        placed.join(recurring, "template")
        .filter(~where.eqNullSafe(F.col("first")))
        .select("doc_id", "text_hash", "line_no", "template")
    )


def _without(lines: Column, dropped: Column) -> Column:
    """Lines but for those at the given places: the runs between them, joined."""
    bounds = F.concat(
        F.array(F.lit(-1)), F.sort_array(dropped), F.array(F.size(lines))
    )
    return let(
        bounds,
        lambda b: F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.size(b) - 1),
                lambda j: F.slice(
                    lines, F.get(b, j - 1) + 2, F.get(b, j) - F.get(b, j - 1) - 1
                ),
            )
        ),
    )


def drop_recurring(docs: DataFrame, with_counts: bool = False, **limits) -> DataFrame:
    """``docs`` without the recurring lines; ``n_chars``, if there, follows the text.

    With ``with_counts`` also n_lines and n_dropped. Every row stays, if need be
    with an empty text. Defined results: a null text stays null and has no
    lines; an empty one has one empty line, which stays; rows that share a
    doc_id are told apart by their text, and equal rows are treated alike, as
    one document; lines of fewer than ``min_tokens`` tokens stay; other columns
    are passed through, whatever their names, but for n_lines and n_dropped, which
    ``with_counts`` replaces.
    """
    own = free_prefix(docs.columns)
    drop_id, drop_hash, places = f"{own}id", f"{own}hash", f"{own}dropped"
    dropped = F.col(places)
    drops = (
        recurring_lines(docs.select("doc_id", "text"), **limits)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("line_no").alias(places))
        .withColumnsRenamed({"doc_id": drop_id, "text_hash": drop_hash})
    )
    same = docs["doc_id"].eqNullSafe(F.col(drop_id)) & (
        F.xxhash64(docs["text"]) == F.col(drop_hash)
    )
    joined = docs.join(drops, same, "left")
    kept = let(
        F.split("text", "\n"),
        lambda lines: F.array_join(_without(lines, dropped), "\n"),
    )
    text = F.when(dropped.isNull(), F.col("text")).otherwise(kept)
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out["text"] = text
    if "n_chars" in out:
        out["n_chars"] = F.when(dropped.isNull(), F.col("n_chars")).otherwise(
            F.char_length(text).cast("bigint")
        )
    if with_counts:
        out["n_lines"] = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("bigint")
        out["n_lines"] = F.when(F.col("text").isNull(), 0).otherwise(out["n_lines"])
        out["n_dropped"] = F.when(dropped.isNull(), 0).otherwise(
            F.size(dropped)
        ).cast("bigint")
    return joined.select(*[c.alias(n) for n, c in out.items()])
