"""Chat formatting by quotation linking.

Messages quote each other with ``>`` marks. Each message is parsed into its own lines and
its quoted passages by nesting level (attribution lines before a quote go). Passages
are normalised (lower case, white space to one space, edge punctuation off), cut into sentences
and hashed, so a quote that was wrapped anew or cut still links. The hashes are joined,
inside the conversation, to the original message: the earliest one whose own text has the
sentence. A message's parent is the original that explains most quoted characters of its
lowest linked level. Messages come out without quotes and in reply order: threads by
the turn of their first message, in a thread by turn, so that a reply follows what it quotes.

Joins are many to one (originals are reduced to the earliest per sentence), threads are
found by pointer doubling, and positions are counted in ranges of turns, so that
no task needs a whole conversation, however many rows one holds.

Results: one row per distinct message, ``n_copies`` saying how often it occurs. A null
conv_id or turn counts as one conversation or first turn of its own. A null role is an empty
one. Null and empty texts stay as empty messages; a message that only quotes is kept with an empty text. A quote of nothing in the
conversation is dropped and links nothing. Messages that share a turn are in order of role and text;
a quote links to a turn, its first row in that order. Other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skewkit.llm.common import arrow_map, map_slices, staged

TURNS_PER_RANGE = 4096
_FIRST = -(1 << 63)

_mark = re.compile(r"[ \t]*((?:>[ \t]?)+)")
#: How mail and forum programs introduce a quote.
ATTRIBUTION = re.compile(r"^.{0,200}\b(wrote|writes|said|a écrit|schrieb|escribió)\s*:\s*$", re.I)
_sentence_end = re.compile(r"(?<=[.!?…。])\s+")
_edges = re.compile(r"^\W+|\W+$")


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text, and its quoted passages with their levels, in order."""
    if not text:
        return "", []
    if ">" not in text:
        return text.strip(), []
    own: list[str] = []
    quotes: list[tuple[int, list[str]]] = []
    level_before = 0
    for line in text.split("\n"):
        m = _mark.match(line)
        level = m[1].count(">") if m else 0
        body = line[m.end():] if m else line
        if level > level_before:
            # the line that introduces the quote belongs to neither message
            holder = quotes[-1][1] if level_before else own
            if holder and ATTRIBUTION.match(holder[-1]):
                holder.pop()
        if level == 0:
            own.append(line)
        elif level == level_before:
            quotes[-1][1].append(body)
        else:
            quotes.append((level, [body]))
        level_before = level
    passages = [(level, "\n".join(lines).strip()) for level, lines in quotes]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip(), [(n, p) for n, p in passages if p]


def sentences(passage: str) -> list[str]:
    """Normalised sentences of a passage; none of them empty."""
    cut = _sentence_end.split(" ".join(passage.split()).lower())
    return [s for s in (_edges.sub("", c) for c in cut) if s]


def _parsed(messages: DataFrame) -> DataFrame:
    """Messages with ``own`` text and ``quotes``: level and sentence of each quoted sentence."""
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        own, quotes, counts = [], [], []
        for text in part.column("text").to_pylist():
            mine, passages = parse(text)
            own.append(mine)
            counts.append(len(passages))
            quotes.append([{"level": level, "sentence": s} for level, p in passages for s in sentences(p)])
        kind = pa.list_(pa.struct([("level", pa.int32()), ("sentence", pa.string())]))
        return pa.record_batch([*[part.column(c) for c in ("conv", "turn", "role", "n_copies")], pa.array(own, pa.string()),
                                pa.array(counts, pa.int32()), pa.array(quotes, kind)],
                               ["conv", "turn", "role", "n_copies", "own", "n_quotes", "quotes"])

    return map_slices(messages, run, "conv long, turn long, role string, n_copies long, own string, n_quotes int, "
                                     "quotes array<struct<level:int,sentence:string>>")


def _own_sentences(messages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, turn, sentence = [], [], []
            for c, t, own in zip(*(x.to_pylist() for x in b.columns), strict=True):
                for s in set(sentences(own)):
                    conv.append(c)
                    turn.append(t)
                    sentence.append(s)
            yield pa.record_batch({"conv": pa.array(conv, pa.int64()), "turn": pa.array(turn, pa.int64()),
                                   "sentence": pa.array(sentence, pa.string())})
    return arrow_map(messages.select("conv", "turn", "own"), run, "conv long, turn long, sentence string")


def _key(column):
    """Hash of a sentence: 64 bits and its length."""
    return [F.xxhash64(column).alias("h"), F.length(column).alias("size")]


def quote_links(messages: DataFrame) -> DataFrame:
    """``conv, turn, parent``: the turn that each quoting message replies to. ``messages`` as ``_parsed`` makes them."""
    quoting = messages.filter(F.size("quotes") > 0)
    wanted = quoting.select("conv", "turn", F.explode("quotes").alias("q")).select(
        "conv", "turn", F.col("q.level").alias("level"), *_key(F.col("q.sentence"))).distinct()
    # only what is quoted somewhere in the conversation can be an original
    asked = wanted.select("conv", "h", "size").distinct()
    originals = (_own_sentences(messages.join(quoting.select("conv").distinct(), "conv", "left_semi"))
                 .select("conv", "turn", *_key(F.col("sentence")))
                 .groupBy("conv", "h", "size").agg(F.min("turn").alias("source")))
    found = wanted.join(originals.join(asked, ["conv", "h", "size"], "left_semi"), ["conv", "h", "size"]).filter("source < turn")
    explained = found.groupBy("conv", "turn", "level", "source").agg(F.sum("size").alias("chars"))
    # the lowest level, then most characters, then the latest original
    best = F.max_by("source", F.struct(-F.col("level"), "chars", "source"))
    return explained.groupBy("conv", "turn").agg(best.alias("parent"))


def thread_roots(links: DataFrame) -> DataFrame:
    """``conv, turn, root, depth`` of every linked message, by pointer doubling; parents have lower turns."""
    spark = links.sparkSession
    hops = staged(spark, links.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")),
                  "threads")
    while True:
        up = hops.select("conv", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = staged(spark, hops.join(up, ["conv", "root"], "left").select(
            "conv", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved")), "threads")
        hops = joined.drop("moved")
        if joined.filter("moved").limit(1).count() == 0:
            return hops


def _rank_in(rows: DataFrame, keys: list[str], order: str, ties: list[str], out: str, weight=None) -> DataFrame:
    """Rows (or ``weight``) before each one by ``order`` within ``keys``, counted in ranges of ``order``."""
    weight = F.lit(1) if weight is None else F.col(weight)
    dealt = rows.withColumn("_bin", F.floor(F.col(order) / TURNS_PER_RANGE).cast("long"))
    bins = dealt.groupBy(*keys, "_bin").agg(F.sum(weight).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*keys, "_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.join(bins, [*keys, "_bin"])
            .withColumn(out, F.col("_before") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .drop("_bin", "_before"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, parent_turn, thread_turn, depth, position, n_quotes, n_copies, chat``.

    ``position`` counts the conversation's messages in reply order from 0; ``chat`` is the message with its role mark.
    """
    spark = conversations.sparkSession
    distinct = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_FIRST)).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_FIRST)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n_copies"))
    messages = staged(spark, _parsed(distinct), "messages")
    links = staged(spark, quote_links(messages), "quote-links")
    threads = thread_roots(links)
    placed = messages.drop("quotes").join(links, ["conv", "turn"], "left").join(threads, ["conv", "turn"], "left").select(
        "conv", "turn", "role", "own", "n_copies", "n_quotes", "parent", F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).alias("depth"))
    sizes = placed.groupBy("conv", "root").agg(F.count("*").alias("n"))
    starts = _rank_in(sizes, ["conv"], "root", [], "start", weight="n").drop("n")
    ranked = _rank_in(placed, ["conv", "root"], "turn", ["role", "own"], "inside").join(starts, ["conv", "root"])

    def shown(column: str):
        return F.when(F.col(column) != _FIRST, F.col(column))
    return ranked.select(
        shown("conv").alias("conv_id"), shown("turn").alias("turn"), "role", F.col("own").alias("text"),
        shown("parent").alias("parent_turn"), shown("root").alias("thread_turn"), "depth",
        (F.col("start") + F.col("inside")).cast("long").alias("position"), "n_quotes", "n_copies",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "own", F.lit("\n")).alias("chat"))
