"""Chat formatting of reply trees.

Every message names the one it replies to. Iterative self-joins enumerate the paths from root to
leaf: each round joins the messages with themselves through the ancestor found so far and so
doubles its distance, adding up scores and lengths on the way; branches are ranked by their sum,
and the chosen ones are walked back by the same ancestors, again doubling. Only numbers of messages
move in these joins, in as many rounds as the depth has binary digits. Texts are shuffled once
(of a chain) or twice (of a tree with branches) and formatted by a task that streams over them.

A formatted turn is ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed.
Control strings inside a role or text get a backslash after their first character, one more if
they already have some, so that taking one off gives the text again; texts without any stay as
they are. In roles, backslashes and line feeds are spelled ``\\\\`` and ``\\n`` as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.base import saved

START, END = "<|im_start|>", "<|im_end|>"

#: The strings that chat templates give a meaning to.
_CONTROL = r"\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>"
_MARKED = re.compile(rf"([<\[])(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_CONTROL})")

#: Code points after which a formatted path goes on in a further part.
PART_CHARS = 1 << 20


def escape(text: str) -> str:
    return _MARKED.sub(r"\1\\\2\3", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text) if "\\" in text else text


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted path."""
    found = []
    for turn in formatted.split(f"{END}\n")[:-1]:
        line, _, text = turn.removeprefix(START).partition("\n")
        found.append((_role(line), unescape(text)))
    return found


def branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, id, paths): the places of each message on the chosen root-to-leaf paths of its tree.

    ``messages`` has tree, id, parent and score. ``paths`` lists (rank, at): the path's rank in its tree and the
    message's number on it, from 0. A path's score is the sum over its messages, null as 0;
    the ``best`` highest are chosen, of equal ones the longer, then that of the smaller leaf.
    A message without a parent, or whose parent does not exist, is a root. Messages that reply to each other in
    a circle, and those below them, have no root and lie on no path. Of repeated ids the smallest parent and the
    highest score hold. Rows without a tree or an id are no messages.
    """
    rows = messages.where(F.col("tree").isNotNull() & F.col("id").isNotNull())
    nodes = rows.groupBy("tree", "id").agg(F.min("parent").alias("up"), F.max("score").alias("score"))
    size = F.count(F.lit(1)).over(Window.partitionBy("tree"))
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    level = nodes.select("tree", "id", "up", score.alias("score"), F.lit(1).cast("long").alias("steps"), size.alias("size"))
    level = saved(level, "replies")
    parents = level.select("tree", F.col("up").alias("id")).where("id is not null").distinct()
    leaves = level.join(parents, ["tree", "id"], "left_anti").select("tree", "id")
    longest = level.agg(F.max("size")).first()[0] or 0

    # Round r finds the ancestor 2^r above. A tree with no more messages than that is through.
    levels, reach = [level], 1
    while reach < longest:
        open_rows = F.col("up").isNotNull() & (F.col("size") > reach)
        higher = level.where(F.col("size") > reach).select(
            "tree", F.col("id").alias("up"), F.col("up").alias("__up"), F.col("score").alias("__score"), F.col("steps").alias("__steps")
        )
        stepped = level.where(open_rows).join(higher, ["tree", "up"], "left").select(
            "tree",
            "id",
            F.col("__up").alias("up"),
            (F.col("score") + F.coalesce("__score", F.lit(0.0))).alias("score"),
            (F.col("steps") + F.coalesce("__steps", F.lit(0).cast("long"))).alias("steps"),
            "size",
        )
        level = saved(stepped.unionByName(level.where(~open_rows)), "replies")
        levels.append(level)
        reach *= 2

    # What still has an ancestor after that many steps goes round in a circle.
    rooted = level.where(F.col("up").isNull() | (F.col("size") == 1))
    ranking = Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("steps").desc(), "id")
    ranked = rooted.join(leaves, ["tree", "id"], "left_semi").withColumn("rank", F.row_number().over(ranking))
    chosen = ranked.where(F.col("rank") <= best)

    # Back along the chosen paths: those found so far stand less than `reach` above the leaf.
    found = [saved(chosen.select("tree", "id", "rank", "steps", (F.col("steps") - 1).alias("at"), "size"), "branches")]
    reach = 1
    for hops in levels:
        if reach >= longest:
            break
        hops = hops.where((F.col("size") > reach) & F.col("up").isNotNull()).select("tree", "id", "up")
        new = None
        for part in found:
            # A place at or above the root has no such ancestor.
            wanted = part.where((F.col("size") > reach) & (F.col("at") >= reach))
            new = wanted if new is None else new.unionByName(wanted)
        moved = new.join(hops, ["tree", "id"]).select(
            "tree", F.col("up").alias("id"), "rank", "steps", (F.col("at") - reach).alias("at"), "size"
        )
        found.append(saved(moved, "branches"))
        reach *= 2
    places = found[0]
    for part in found[1:]:
        places = places.unionByName(part)
    place = F.struct(F.col("rank"), F.col("at"))
    return places.groupBy("tree", "id").agg(F.sort_array(F.collect_list(place)).alias("paths"))


FORMATTED = "rank int, part int, formatted string, loss array<struct<start:bigint,end:bigint>>"


def _formatted(placed: DataFrame, learned: Sequence[str]) -> DataFrame:
    """Rows (tree, rank, at, role, text), sorted in each partition, as formatted parts."""
    kind = placed.schema["tree"].dataType
    schema = T.StructType([T.StructField("tree", kind), *T.StructType.fromDDL(FORMATTED).fields])
    learned = frozenset(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        tree_type = None
        done: list[tuple] = []
        held = 0
        current, pieces, loss, part, chars = None, [], [], 0, 0

        def close() -> None:
            nonlocal pieces, loss, chars, held
            done.append((*current, part, "".join(pieces), loss))
            held += chars
            pieces, loss, chars = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal done, held
            columns = list(zip(*done))
            types = [tree_type, pa.int32(), pa.int32(), pa.string(), span]
            done, held = [], 0
            names = ["tree", "rank", "part", "formatted", "loss"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            tree_type = batch.schema.field(0).type
            for tree, rank, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (tree, rank) != current:
                    if current is not None:
                        close()
                    if held >= PART_CHARS:
                        yield flush()
                    current, part = (tree, rank), 0
                elif chars >= PART_CHARS:
                    close()
                    yield flush()
                    part += 1
                head, body = f"{START}{_role_line(role)}\n", escape(text)
                if role in learned:
                    loss.append({"start": chars + len(head), "end": chars + len(head) + len(body)})
                pieces += [head, body, END, "\n"]
                chars += len(head) + len(body) + len(END) + 1
        if current is not None:
            close()
        if done:
            yield flush()

    return placed.select("tree", "rank", "role", "text").mapInArrow(run, schema)


def _attached(texts: DataFrame, paths: DataFrame, by: Sequence[str], number: Column | None) -> DataFrame:
    """(tree, rank, at, role, text): the places of ``paths`` put on the rows of ``texts`` by tree and id.

    Both go through one shuffle, by ``by``; windows in the same partitioning do the rest. ``number``
    gives the id of a text where only that shuffle brings its tree together.
    """
    none = F.lit(None)
    kind = paths.schema["paths"].dataType
    rows = texts.select("tree", "id", "role", "text", none.cast(kind).alias("paths"), F.lit(True).alias("is_text"), *([] if number is None else ["turn"]))
    places = paths.select("tree", "id", none.cast("string").alias("role"), none.cast("string").alias("text"), "paths", F.lit(False).alias("is_text"))
    both = rows.unionByName(places, allowMissingColumns=True).repartition(*by)
    if number is not None:
        both = both.withColumn("id", F.when(F.col("is_text"), number).otherwise(F.col("id")))
    found = both.withColumn("paths", F.max("paths").over(Window.partitionBy("tree", "id"))).where("is_text")
    return found.select("tree", F.inline("paths"), "role", "text")


def _texts(messages: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]


def format_trees(messages: DataFrame, best: int = 1, learned: Sequence[str] = ("assistant",)) -> DataFrame:
    """The ``best`` branches of every reply tree, each formatted as one conversation.

    ``messages`` has tree, id, parent, role, text and score (see ``branches``); other columns are not looked at.
    Returns tree, rank, part, formatted and loss: the spans (code points of that part, end exclusive) that a model
    should learn, the texts of the ``learned`` roles. A path longer than about a million
    code points goes on in further parts, cut between turns. Null roles and texts are empty. Rows with
    one id stand on its place one after the other, by role and text. No messages, no rows. Trees may be of any size:
    their messages are dealt out by id, and only those on chosen paths come together.
    """
    places = branches(messages, best)
    rows = messages.where("tree is not null and id is not null").select("tree", "id", *_texts(messages))
    found = _attached(rows, places, ["tree", "id"], None)
    return _formatted(
        found.repartition("tree", "rank").sortWithinPartitions("tree", "rank", "at", "role", "text"), learned
    )


def format_conversations(conversations: DataFrame, learned: Sequence[str] = ("assistant",)) -> DataFrame:
    """Conversations of (conv_id, turn, role, text) as trees in which each turn replies to the one before.

    Returns ``format_trees`` with the conv_id as tree. Turns stand in the order of ``turn``, null first; those of one
    turn by role and text, repeated rows one after the other. Rows without a conv_id belong to no
    conversation. The joins need the number of turns only, so texts are shuffled once, by conversation,
    and numbered there; a task sorts (spilling) and streams, whatever the length.
    """
    rows = conversations.where("conv_id is not null")
    counted = rows.groupBy(F.col("conv_id").alias("tree")).agg(F.count(F.lit(1)).alias("n"))
    chain = counted.select("tree", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("id"))
    chain = chain.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"))
    texts = rows.select(F.col("conv_id").alias("tree"), F.lit(None).cast("long").alias("id"), "turn", *_texts(rows))
    along = Window.partitionBy("tree", "is_text").orderBy("turn", "role", "text")
    number = F.row_number().over(along).cast("long")
    found = _attached(texts, branches(chain), ["tree"], number)
    return _formatted(found.sortWithinPartitions("tree", "rank", "at"), learned)


DIGEST = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(formatted: DataFrame) -> DataFrame:
    """(tree, rank, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from formatted parts.

    The parts of a path must follow each other, as ``format_trees`` gives them.
    """
    kind = formatted.schema["tree"].dataType
    schema = T.StructType([T.StructField("tree", kind), T.StructField("rank", T.IntegerType()), *T.StructType.fromDDL(DIGEST).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        current = state = None

        def row() -> tuple:
            n, turns, chars, loss, all_chars = state
            return (*current, n, turns.hexdigest(), chars, loss.hexdigest(), all_chars)

        for batch in batches:
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            done = []
            for tree, rank, text, spans in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if (tree, rank) != current:
                    if current is not None:
                        done.append(row())
                    current, state = (tree, rank), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = turns_of(text)
                state[0] += len(turns)
                state[1].update("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                masked = [unescape(text[s["start"] : s["end"]]) for s in spans]
                state[2] += sum(map(len, masked))
                state[3].update("".join(masked).encode())
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), types)], names)

    return formatted.mapInArrow(run, schema)
