"""Chat formatting of reply trees.

Messages point at the message they answer. Iterative self-joins double the reach of every pointer
until all end at a root, which gives each message its depth and the summed score of its branch; the
leaves are ranked by that score, and a second round of self-joins lists the messages of each chosen
branch. Every chosen branch is formatted as one conversation with a loss mask over its assistant
turns. A table of plain conversations is a forest in which each turn answers the one before it.

The template is <|im_start|>role, line feed, text, <|im_end|>, line feed for each turn. Control
strings inside texts and roles get a backslash after their first character (strings that already look
escaped get one more), so that no text can forge a turn and unescaping restores the text exactly.

Defined results: a null text or role formats as the empty one; rows of equal turn are ordered by role,
then text, and all kept; rows of a null conv_id form one conversation; a message whose parent is null
or unknown is a root; messages on a cycle reach no root and are in no conversation; ties of branch
score go to the smallest leaf id; a
conversation, however long, is one value; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import global_index, materialize

START, END = "<|im_start|>", "<|im_end|>"
BLOCK = 256  # turns gathered at once on the way to one conversation
TRAINED = "assistant"

_TAILS = r"(/?s>|/?INST\]|/?SYS>>|<SYS>>|</SYS>>|unk>|pad>|\|[A-Za-z0-9_]+\|>)"
_PLAIN = re.compile(r"([<\[])(\\*)" + _TAILS)
_MARKED = re.compile(r"([<\[])\\(\\*)" + _TAILS)


def escape(text: str) -> str:
    """text with every control string broken by a backslash."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    """The inverse of escape."""
    return _MARKED.sub(r"\1\2\3", text)


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, loss mask as code-point spans) of turns (role, text)."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head = f"{START}{_role(role or '')}\n"
        body = escape(text or "")
        if role == TRAINED:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), mask


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        head, body = part.split("\n", 1)
        turns.append((_unrole(head), unescape(body[: -len(END) - 1])))
    return turns


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(head: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(head))


def as_messages(conversations: DataFrame) -> DataFrame:
    """Turns as messages (tree, node, parent, role, text, score): each answers the one before it."""
    turns = conversations.select(
        F.col("conv_id").alias("tree"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    keys = [F.col("tree").isNull(), F.col("tree"), F.col("turn").isNull(), F.col("turn"), F.col("role"), F.col("text")]
    m = global_index(turns, keys, "chat-turns", "node")
    before = m.select((F.col("node") + 1).alias("node"), F.col("tree").alias("tree_before"), F.col("node").alias("parent"))
    same = F.col("tree").eqNullSafe(F.col("tree_before")) & F.col("parent").isNotNull()
    return m.join(before, "node", "left").select("tree", "node", F.when(same, F.col("parent")).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, path, node, depth) for the top branches of each tree; path is the branch's leaf.

    messages has (tree, node, parent, score) with node unique in the table.
    """
    links = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = links.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    up = F.when(F.col("known"), F.col("parent")).alias("up")
    one, total = F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")
    # Messages without a parent all have the same null key: they stay out of the join.
    roots = links.filter("parent IS NULL").select("tree", "node", F.col("parent").alias("up"), one, total)
    n = messages.count()
    base = materialize(roots.union(links.filter("parent IS NOT NULL").join(known, "parent", "left").select("tree", "node", up, one, total)), "chat-level", rows=n)
    # Pointers that have reached a root rest; only the others are joined in the next round.
    ended = ["up IS NULL", "up IS NOT NULL"]
    rooted, moving, levels = base.filter(ended[0]), base.filter(ended[1]), []
    # A branch has no more messages than there are: pointers that reach further up are on a cycle.
    while 1 << len(levels) <= n and not moving.isEmpty():
        levels.append(moving.select(F.col("node").alias("at"), F.col("up").alias("above")))
        far = rooted.union(moving).select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"), F.col("total").alias("total2"))
        both = moving.join(far, "up").select("tree", "node", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"), (F.col("total") + F.col("total2")).alias("total"))
        both = materialize(both, "chat-level", rows=n)
        rooted, moving = rooted.union(both.filter(ended[0])), both.filter(ended[1])
    leaves = rooted.join(base.select(F.col("up").alias("node")), "node", "left_anti")
    if top == 1:
        best = leaves.groupBy("tree").agg(F.min(F.struct((-F.col("total")).alias("t"), F.col("node"), F.col("steps"))).alias("b")).select("tree", F.col("b.node").alias("path"), F.col("b.steps").alias("length"))
    else:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
        best = leaves.withColumn("rank", rank).filter(F.col("rank") <= top).select("tree", F.col("node").alias("path"), F.col("steps").alias("length"))
    walk = materialize(best.select("tree", "path", F.col("path").alias("node"), F.col("length").alias("depth")), "chat-walk", rows=n)
    for k in reversed(range(len(levels))):
        # From every message reached so far that is deep enough, also the one 2**k replies above it.
        hop = walk.filter(F.col("depth") > (1 << k)).join(levels[k], F.col("node") == F.col("at"))
        hop = materialize(hop.select("tree", "path", F.col("above").alias("node"), (F.col("depth") - (1 << k)).alias("depth")), "chat-walk", rows=top * n)
        walk = walk.union(hop)
    return walk


def conversations_of(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, path, turns) for the top branches; turns is an array of blocks of (depth, role, text)."""
    steps = branches(messages, top)
    texts = messages.select("node", "role", "text")
    turn = F.struct("depth", "role", "text")
    blocks = steps.join(texts, "node").groupBy("tree", "path", F.expr(f"depth div {BLOCK}").alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return blocks.groupBy("tree", "path").agg(F.sort_array(F.collect_list(F.struct("block", "turns"))).alias("blocks")).select("tree", "path", F.col("blocks.turns").alias("turns"))


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, path, formatted, mask) for the top branches; mask is an array of [start, end) code points."""
    whole = conversations_of(messages, top)
    tree = whole.schema["tree"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                part = b.slice(i, 1)
                turns = [(t["role"], t["text"]) for block in part.column(2)[0].as_py() for t in block]
                text, mask = format_turns(turns)
                spans = pa.array([[list(m) for m in mask]], pa.list_(pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([text]), spans], names=["tree", "path", "formatted", "mask"])

    return whole.mapInArrow(run, f"tree {tree}, path {whole.schema['path'].dataType.simpleString()}, formatted string, mask array<array<bigint>>")


def digests(formatted: DataFrame) -> DataFrame:
    """(tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output."""
    tree = formatted.schema["tree"].dataType.simpleString()
    names = ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        for b in batches:
            rows = []
            for text, mask in zip(b.column("formatted"), b.column("mask")):
                text, mask = text.as_py(), mask.as_py()
                turns = parse_turns(text)
                loss = "".join(unescape(text[lo:hi]) for lo, hi in mask)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((len(turns), _sha(whole), len(loss), _sha(loss), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("tree"), *cols], names=names)

    return formatted.mapInArrow(run, f"tree {tree}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
