"""Chat formatting by quotation linking.

A message may quote earlier ones with `>` marks, nested to any depth. Its lines are parsed into
passages, runs of lines of one quote level; a passage is normalised (lower case, blanks
collapsed) and hashed. Hashes of quoted passages are joined to those of the messages' own
passages: a passage belongs to the earliest message that has it, first within the thread the
message came in, else anywhere before it. A passage that matches nowhere as a whole is looked up
by paragraphs, and a message's own paragraphs can be quoted alone. The latest message quoted at
the lowest level that has a match is the parent. Following parents by doubling gives each message its conversation and
depth; the messages of a conversation in order of time, without their quotes, are the result.

Own passages are one row per hash and thread before the join, so a passage that many messages
share meets each quotation once. All joins are between written tables and split when hot.

Everything is DataFrame code. Defined cases: a null text counts as empty; a message without
quotes, or whose quotes match nothing earlier, starts a conversation; a null thread is a thread
of its own; messages need distinct identifiers, rows that repeat one are one message (the
smallest text stays); rows with a null identifier cannot be linked and are left out; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidefold.llm.common import let, materialise

_QUOTE = r"^((?:>[ \t]*)+)"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def parse_passages(text: Column) -> Column:
    """Array of (level, body): runs of lines of one quote level, in order; level 0 is the message's own."""
    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, _QUOTE, 1)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.when(F.length(marks) > 0, F.substring(line, F.length(marks) + 1, F.length(line))).otherwise(line).alias("body"),
        )

    lines = F.transform(F.split(text, "\n"), parsed)

    def runs(rows: Column) -> Column:
        # Places where the level changes are the starts of runs.
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (F.get(rows, i)["level"] != F.get(rows, i - 1)["level"]))

        def cut(at: Column) -> Column:
            return F.transform(at, lambda start, k: F.struct(
                F.get(rows, start)["level"].alias("level"),
                F.array_join(
                    F.transform(
                        F.slice(rows, start + 1, F.coalesce(F.get(at, k + 1), F.size(rows)) - start), lambda r: r["body"]
                    ), "\n",
                ).alias("body"),
            ))

        return let(starts, cut)

    return let(lines, runs)


def _passages(messages: DataFrame) -> DataFrame:
    """Rows (thread, id, level, hash, body) of every passage with a visible character."""
    exploded = messages.select("thread", "id", F.posexplode(parse_passages(F.col("text"))).alias("place", "p"))
    return exploded.select(
        "thread", "id", "place", F.col("p.level").alias("level"), F.col("p.body").alias("body"),
        normalised(F.col("p.body")).alias("plain"),
    )


def _units(passages: DataFrame) -> DataFrame:
    """Rows (thread, id, place, level, whole, hash): whole passages, and the paragraphs of those with several."""
    parts = F.filter(F.transform(F.split("body", r"\n[\x20\x09-\x0D]*\n"), normalised), lambda part: part != "")
    exploded = passages.where("plain != ''").select(
        "thread", "id", "place", "level", "plain",
        F.explode(let(parts, lambda several: F.concat(
            F.array(F.lit(None).cast("string")), F.when(F.size(several) > 1, F.array_distinct(several)).otherwise(F.array().cast("array<string>"))
        ))).alias("part"),
    )
    return exploded.select(
        "thread", "id", "place", "level", F.col("part").isNull().alias("whole"), F.md5(F.coalesce("part", "plain")).alias("hash")
    )


def _links(passages: DataFrame, blank_answers: bool) -> DataFrame:
    """Rows (id, parent): the latest message that a passage of the lowest level with a match belongs to."""
    units = materialise(_units(passages), "quote-units")
    own = materialise(
        units.where("level = 0").groupBy("hash", "thread").agg(F.min("id").alias("part"), F.min(F.when(F.col("whole"), F.col("id"))).alias("whole")),
        "quote-own",
    )
    far = own.groupBy("hash").agg(F.min("part").alias("far_part"), F.min("whole").alias("far_whole"))
    far = materialise(far, "quote-far")
    quoted = units.where("level > 0").select("id", "place", "level", F.col("whole").alias("run"), "hash", "thread")
    if blank_answers:
        blank = materialise(passages.where("level = 1 AND plain = ''").select("id").distinct(), "quote-blank")
        quoted = quoted.where("level = 1").union(quoted.where("level > 1").join(blank, "id", "left_anti").select(*quoted.columns))
    near = own.select("hash", F.col("thread").alias("own_thread"), "part", "whole")

    def earlier(name: str) -> Column:
        return F.when(F.col(name) < F.col("id"), F.col(name))

    in_thread = materialise(
        quoted.join(near, (quoted["hash"] == near["hash"]) & quoted["thread"].eqNullSafe(near["own_thread"]), "left")
        .select("id", "place", "level", "run", quoted["hash"], earlier("part").alias("part"), earlier("whole").alias("whole")),
        "quote-near",
    )
    found = in_thread.join(far, "hash", "left").select(
        "id", "place", "level", F.when(F.col("run"), F.coalesce("whole", earlier("far_whole"))).alias("whole"),
        F.coalesce("part", earlier("far_part")).alias("part"),
    )
    # A passage's own match comes before those of its paragraphs.
    placed = found.groupBy("id", "level", "place").agg(F.coalesce(F.max("whole"), F.max("part")).alias("parent"))
    levels = placed.where("parent IS NOT NULL").groupBy("id", "level").agg(F.max("parent").alias("parent"))
    return levels.groupBy("id").agg(F.min_by("parent", "level").alias("parent"))


def _roots(nodes: DataFrame) -> DataFrame:
    """Rows (id, parent, root, depth) by pointer doubling over `nodes(id, parent)`; parents are older, so it ends.

    A message whose pointer has reached the start of its conversation is done and takes no part
    in further rounds; only the deep rest of long conversations does.
    """
    start = materialise(
        nodes.select("id", "parent", F.coalesce("parent", "id").alias("root"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth")),
        "quote-walk",
    )
    done, active = start.where("parent IS NULL"), start.where("parent IS NOT NULL")
    while True:
        above = done.union(active).select(F.col("id").alias("above"), F.col("root").alias("next_root"), F.col("depth").alias("more"))
        stepped = materialise(
            active.join(above, active["root"] == above["above"]).select(
                "id", "parent", F.col("next_root").alias("root"), (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("next_root") != active["root"]).alias("moved"),
            ),
            "quote-walk",
        )
        done = done.union(stepped.where("NOT moved").drop("moved"))
        active = stepped.where("moved").drop("moved")
        if active.isEmpty():
            return done


def link_quotes(messages: DataFrame, id_col: str = "id", text_col: str = "text", thread_col: str = "thread",
                blank_answers: bool = False) -> DataFrame:
    """One row per message: id, parent, conversation (id of its first message), depth, n_quoted, body.

    `body` is the text without quoted passages. Rows are sorted by conversation and id, which is
    the order of replies; identifiers grow with time. They are numbers, or structs whose order is
    that of time. With `blank_answers` a blank passage at level one quotes a message without text,
    and what lies deeper does not stand in for it.
    """
    id_type = messages.schema[id_col].dataType
    id_type = id_type if isinstance(id_type, StructType) else LongType()
    plain = materialise(
        messages.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast(id_type).alias("id")).agg(
            F.min(F.struct(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.col(f"`{thread_col}`").alias("thread"))).alias("m")
        ).select("id", "m.text", "m.thread"),
        "quote-messages",
    )
    passages = materialise(_passages(plain), "quote-passages")
    links = _links(passages, blank_answers)
    bodies = passages.groupBy("id").agg(
        F.count_if(F.col("level") > 0).alias("n_quoted"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.when(F.col("level") == 0, F.struct("place", "body")))), lambda p: p["body"]), "\n"
        ).alias("body"),
    )
    nodes = materialise(bodies.join(links, "id", "left"), "quote-nodes")
    roots = _roots(nodes.select("id", "parent"))
    return (
        nodes.select("id", "n_quoted", "body")
        .join(roots, "id")
        .select("id", "parent", F.col("root").alias("conversation"), "depth", "n_quoted", "body")
        .orderBy("conversation", "id")
    )
