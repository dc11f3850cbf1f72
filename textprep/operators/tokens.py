"""Tokenisation as Spark jobs.

Pieces come from the public cl100k pre-token split (``functions.patterns.PIECE``).
The vocabulary is built from the data: each distinct piece gets an id by
(frequency desc, piece) position, computed with the distributed global rank.
Encoding joins pieces to the vocabulary: the ids under the broadcast bound
(the most frequent pieces, since ids are frequency ranks) are broadcast and
resolve most occurrences map-side; only the remaining occurrences shuffle-join
the rest of the vocabulary.  Pieces of one text are put back in
order with ``collect_list`` of (position, id), packed into one number, or one
string where the value is a piece; the partial aggregate runs in the task that
exploded the text, so one array per text crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pieces
from ..session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, row_bytes
from .rank import global_rank


def piece_table(df: DataFrame, text_col: str = "text", id_col: str = "ord", pos_col: str = "pos") -> DataFrame:
    """(id, pos, piece): one row per piece occurrence, in text order."""
    return df.select(
        F.col(id_col), F.posexplode_outer(pieces(F.col(text_col))).alias(pos_col, "piece")
    ).where(F.col("piece").isNotNull())


def build_vocab(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(token_id, piece, freq): ids 0.. by frequency desc, then piece."""
    freq = (
        df.select(F.explode_outer(pieces(F.col(text_col))).alias("piece"))
        .where(F.col("piece").isNotNull())
        .groupBy("piece").agg(F.count(F.lit(1)).alias("freq"))
    )
    # the rank reads a checkpointed sort, so its ids are stable on every reuse
    ranked = global_rank(freq, [F.col("freq").desc(), F.col("piece")], "token_id")
    return ranked.select(F.col("token_id").cast("int").alias("token_id"), "piece", "freq")


HOT_STEPS = 256
TASK_PIECES = 2_000_000  # occurrences of a task, about: they are sorted back into texts in memory


def hot_ids(vocab: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[int, int]:
    """(end, n): the ids below ``end`` are at most ``max_rows`` entries of at most ``max_bytes``
    bytes in all; ``n`` is the vocabulary's size.  A piece may be a whole text, so ids alone
    bound nothing: bytes are summed in ``HOT_STEPS`` steps of ids (that many small rows)."""
    step = max(1, -(-max_rows // HOT_STEPS))
    per = vocab.groupBy(F.least(F.floor(F.col("token_id") / step), F.lit(HOT_STEPS)).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(vocab, "token_id", "piece")).alias("b"))
    rows = {r["s"]: r for r in per.collect()}
    end, size = 0, 0
    for s in range(HOT_STEPS):
        size += rows[s]["b"] if s in rows else 0
        if size > max_bytes:
            break
        end = min((s + 1) * step, max_rows)
    return end, sum(r["n"] for r in rows.values())


def _lookup(occ: DataFrame, vocab: DataFrame, key: str, value: str, max_rows: int) -> DataFrame:
    """Left-join ``occ`` to (key -> value) of the vocabulary.

    Token ids are frequency ranks, so the lowest ids are the most frequent
    entries: those within ``max_rows`` rows and the byte bound are broadcast and
    resolve most occurrences in the task that made them.  Only occurrences
    still unresolved meet the rest of the vocabulary in a shuffle join.  When
    the whole vocabulary is under the bound there is no shuffle join at all.
    ``build_vocab`` reads a checkpoint, so measuring it is cheap.
    """
    end, n = hot_ids(vocab, max_rows)
    v = vocab.select(key, value)
    hot = F.broadcast(v.where(F.col("token_id") < F.lit(end)))
    first = occ.join(hot, key, "left")
    if n <= end:
        return first
    done = first.where(F.col(value).isNotNull())
    cold = v.where(F.col("token_id") >= F.lit(end))
    rest = first.where(F.col(value).isNull()).drop(value).join(cold, key, "left")
    return done.unionByName(rest)


def encode(df: DataFrame, vocab: DataFrame, text_col: str = "text", id_col: str = "ord",
           out: str = "tokens", broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """(id, tokens: array<int>) for every row; pieces missing from the vocabulary
    make the row's tokens null (use a vocabulary built over the same texts).

    A text without pieces keeps one row from ``posexplode_outer`` and gets an
    empty array, so no join back to the ids is needed.  The texts are dealt out by
    id, ``TASK_PIECES`` pieces a task: so a task's pieces, many times its texts, need
    no disk, and where all pieces are broadcast they are put together in place.
    """
    conf = df.sparkSession.conf
    found = vocab.agg(F.sum("freq")).first()[0] or 0 if "freq" in vocab.columns else 0
    tasks = max(int(conf.get("spark.sql.shuffle.partitions")), -(-found // TASK_PIECES))
    dealt = df.select(id_col, text_col).repartition(tasks, id_col)
    occ = dealt.select(F.col(id_col), F.posexplode_outer(pieces(F.col(text_col))).alias("_at", "piece"))
    joined = _lookup(occ, vocab, "piece", "token_id", broadcast_max_rows)
    # position above, id below: as numbers they sort as the pairs do
    packed = F.shiftleft(F.col("_at").cast("long"), 32).bitwiseOR(F.col("token_id").cast("long"))
    agg = joined.groupBy(id_col).agg(
        F.sort_array(F.collect_list(packed)).alias("_p"),
        F.count_if(F.col("_at").isNotNull() & F.col("token_id").isNull()).alias("_miss"),
    )
    return agg.select(
        id_col,
        F.when(F.col("_miss") == 0, F.transform("_p", lambda s: s.bitwiseAND(0xFFFFFFFF).cast("int"))).alias(out),
    )


def decode(df: DataFrame, vocab: DataFrame, tokens_col: str = "tokens", id_col: str = "ord",
           out: str = "text", broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """(id, text) by joining ids back to pieces; a row with an unknown id is left out."""
    occ = df.select(F.col(id_col), F.posexplode_outer(F.col(tokens_col)).alias("_at", "token_id"))
    joined = _lookup(occ, vocab, "token_id", "piece", broadcast_max_rows)
    # eight hex digits of the position before the piece: as strings they sort as the pairs do
    packed = F.concat(F.lpad(F.hex("_at"), 8, "0"), F.col("piece"))
    agg = joined.groupBy(id_col).agg(
        F.sort_array(F.collect_list(packed)).alias("_p"),
        F.count_if(F.col("_at").isNotNull() & F.col("piece").isNull()).alias("_miss"),
    )
    return agg.where(F.col("_miss") == 0).select(
        id_col, F.array_join(F.transform("_p", lambda s: F.substr(s, F.lit(9))), "").alias(out)
    )


def length_ok(n_tokens, lo: int, hi: int):
    """Inclusive length window (P10)."""
    return (n_tokens >= F.lit(lo)) & (n_tokens <= F.lit(hi))
