"""Mixing sources to target shares of tokens, a source being used at most a capped number of times.

The documents of each source are tokenised and packed end to end into blocks of fixed length. Each output shard draws
its source counts from a multinomial distribution seeded by mix and shard; the slots of a source, counted on over the
shards, are mapped through a pseudorandom permutation of the source's block numbers, one permutation for each use of
the source; blocks are joined to slots by source and number.

A large source is packed in parts whose number follows its documents, so no task gets a whole source. Slots and
blocks are joined by source *and* block number, which spreads a source that holds a third of all documents evenly.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellumine.sources.tables import settled

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Shards whose draws are summed up in one group.
GROUP = 4096
#: The blocks that a source without max_repeats may give.
NO_CAP = 1 << 40
# Fixed value: the public pre-tokenisation pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str):
    """The public tokenizer of a vocabulary file of ranks; read once by each Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, n_tokens`` of each distinct document of a source; null and empty texts have no tokens and are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "text_key": pdf["text_key"], "n_tokens": [len(encode(t.encode("utf-8", "replace").decode())) for t in pdf["text"]]})

    docs = documents.filter(F.col("doc_id").isNotNull() & F.col("source").isNotNull() & (F.length("text") > 0)).select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64("text").alias("text_key"), "text")
    counted = docs.mapInPandas(run, "doc_id long, source string, text_key long, n_tokens long")
    return counted.dropDuplicates(["doc_id", "source", "text_key"]).filter("n_tokens > 0")


def permuted(places: np.ndarray, n: int, key: int, rounds: int = 4) -> np.ndarray:
    """The places 0..n-1 under a pseudorandom permutation chosen by *key*: a Feistel network, walked until it is below n."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = places.astype(np.uint64), np.ones(len(places), dtype=bool)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF) for r in range(rounds)]
    with np.errstate(over="ignore"):
        while todo.any():
            x = out[todo]
            left, right = x >> np.uint64(half), x & mask
            for k in keys:
                z = (right ^ k) * np.uint64(0xFF51AFD7ED558CCD)
                z = (z ^ (z >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
                left, right = right, left ^ ((z ^ (z >> np.uint64(29))) & mask)
            out[todo] = left << np.uint64(half) | right
            todo[todo] = out[todo] >= np.uint64(n)
    return out.astype(np.int64)


def _source_key(source: str, seed: int, use: int) -> int:
    import zlib

    return (zlib.crc32(source.encode()) << 20) ^ (seed << 8) ^ use


class Mixer:
    """The mixes of ``mix_targets`` (``mix_id, source, target_share, max_repeats``) over ``documents`` (``doc_id, text, source``).

    Documents without source or text take no part. Rows of mix_targets that are repeated count once; a null source is
    one without documents; rows without mix_id are left out, a NaN share is null, and nothing is drawn for shares
    that are null or not above 0; they are neither reachable nor unreachable. Empty tables give empty results. Other columns are ignored.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, block: int = 1024, slots: int = 256, seed: int = 7, part_docs: int = 50_000, tokenizer: str = TOKENIZER):
        self.spark, self.block, self.slots, self.seed, self.part_docs = documents.sparkSession, block, slots, seed, part_docs
        self.tokenizer, self.documents = tokenizer, documents
        self.targets = targets.filter(F.col("mix_id").isNotNull()).select("mix_id", "source", F.when(~F.isnan("target_share"), F.col("target_share")).alias("target_share"), "max_repeats").distinct()

    @cached_property
    def counted(self) -> DataFrame:
        return settled(token_counts(self.documents, self.tokenizer), self.spark)

    @cached_property
    def packed(self) -> DataFrame:
        """Each document's place in the stream of its part of its source: ``source, part, doc_id, start, n_tokens``."""
        docs = self.counted
        parts = docs.groupBy("source").agg(F.ceil(F.count("*") / F.lit(self.part_docs)).cast("long").alias("parts"))
        placed = docs.join(parts, "source").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(self.seed)), F.col("parts")))
        order = W.partitionBy("source", "part").orderBy(F.xxhash64("doc_id", F.lit(self.seed + 1)), "doc_id", "text_key")
        return placed.select("source", "part", "doc_id", "n_tokens", (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("start"))

    @cached_property
    def parts(self) -> DataFrame:
        """``source, part, tokens, blocks, first_block``: of each part its size and the number of its first block in the source."""
        by = self.packed.groupBy("source", "part").agg(F.sum("n_tokens").alias("tokens")).withColumn("blocks", F.ceil(F.col("tokens") / F.lit(self.block)).cast("long"))
        return settled(by.withColumn("first_block", F.sum("blocks").over(W.partitionBy("source").orderBy("part")) - F.col("blocks")), self.spark)

    @cached_property
    def blocks(self) -> DataFrame:
        """``source, block_no, block_tokens``: the blocks of each source, all full but the last of each part."""
        numbered = self.parts.select("source", "tokens", "first_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("at"))
        return numbered.select("source", (F.col("first_block") + F.col("at")).alias("block_no"), F.least(F.lit(self.block).cast("long"), F.col("tokens") - F.col("at") * self.block).alias("block_tokens"))

    def pieces(self) -> DataFrame:
        """``source, block_no, doc_id, token_from, token_to``: what each block holds, in token places of the documents."""
        docs = self.packed.join(self.parts.select("source", "part", "first_block"), ["source", "part"])
        at = docs.withColumn("at", F.explode(F.sequence(F.floor(F.col("start") / self.block), F.floor((F.col("start") + F.col("n_tokens") - 1) / self.block))))
        lo = F.greatest(F.col("at") * self.block - F.col("start"), F.lit(0))
        hi = F.least((F.col("at") + 1) * self.block - F.col("start"), F.col("n_tokens"))
        return at.select("source", (F.col("first_block") + F.col("at")).alias("block_no"), "doc_id", lo.cast("long").alias("token_from"), hi.cast("long").alias("token_to"))

    @cached_property
    def sources(self) -> DataFrame:
        """``source, tokens, blocks`` of each source, summed over its blocks."""
        return self.blocks.groupBy("source").agg(F.sum("block_tokens").alias("tokens"), F.count("*").alias("blocks"))

    @cached_property
    def capacity(self) -> DataFrame:
        """The targets with the tokens of the source and of all sources of the mix."""
        own = self.targets.join(self.sources, "source", "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0)).cast("long"), "blocks": F.coalesce("blocks", F.lit(0)).cast("long")})
        mix = W.partitionBy("mix_id")
        return own.withColumns({"mix_tokens": F.sum("tokens").over(mix), "mix_blocks": F.sum("blocks").over(mix)})

    def _multinomials(self, asked: DataFrame, round_: int) -> DataFrame:
        """``mix_id, shard, source, n, blocks, cap`` of rows ``mix_id, shard, slots, of``: *slots* slots of a shard drawn
        among the sources *of* by their shares; the draws depend on seed, mix, shard and round only."""
        seed = self.seed

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = []
                for mix, shard, slots, of in zip(pdf["mix_id"], pdf["shard"], pdf["slots"], pdf["of"]):
                    shares = np.array([x["target_share"] for x in of], dtype=float)
                    counts = np.random.default_rng([seed, int(mix) & 0xFFFFFFFF, int(shard), round_]).multinomial(int(slots), shares / shares.sum())
                    rows.extend((mix, shard, x["source"], int(n), x["blocks"], x["cap"]) for x, n in zip(of, counts) if n)
                yield pd.DataFrame(rows, columns=["mix_id", "shard", "source", "n", "blocks", "cap"])

        kind = self.targets.schema["mix_id"].dataType.simpleString()
        return asked.mapInPandas(run, f"mix_id {kind}, shard long, source string, n long, blocks long, cap long")

    def _numbered(self, draws: DataFrame, taken: DataFrame | None = None) -> DataFrame:
        """The draws with *before*, the slots of the source in the shards before (and those *taken* earlier), and *granted*,
        what is left of the cap for them. Sums are of groups of shards and within them, so that no task gets all shards."""
        draws = draws.withColumn("g", F.floor(F.col("shard") / GROUP))
        by_group = draws.groupBy("mix_id", "source", "g").agg(F.sum("n").alias("group_n"))
        earlier = F.sum("group_n").over(W.partitionBy("mix_id", "source").orderBy("g")) - F.col("group_n")
        draws = draws.join(by_group.withColumn("earlier", earlier).drop("group_n"), ["mix_id", "source", "g"])
        if taken is not None:
            draws = draws.join(taken, ["mix_id", "source"]).withColumn("earlier", F.col("earlier") + F.col("taken")).drop("taken")
        within = F.sum("n").over(W.partitionBy("mix_id", "source", "g").orderBy("shard")) - F.col("n")
        draws = draws.withColumn("before", F.col("earlier") + within).drop("g", "earlier")
        return draws.withColumn("granted", F.least(F.col("n"), F.greatest(F.col("cap") - F.col("before"), F.lit(0))))

    @cached_property
    def first_draws(self) -> DataFrame:
        """The draws of all slots by target shares: as many slots as the mix's sources have blocks, in shards."""
        slots, by = self.slots, F.struct("source", "target_share", "blocks", F.coalesce(F.col("max_repeats").cast("long") * F.col("blocks"), F.lit(NO_CAP)).alias("cap"))
        mixes = self.capacity.filter("source is not null and target_share > 0").groupBy("mix_id", "mix_blocks").agg(F.sort_array(F.collect_list(by)).alias("of"))
        mixes = mixes.filter("mix_blocks > 0").withColumn("shards", F.ceil(F.col("mix_blocks") / slots))
        groups = mixes.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("shards") - 1) / GROUP))).alias("g"))
        last = F.least((F.col("g") + 1) * GROUP, F.col("shards")) - 1
        shards = groups.select("mix_id", "of", "mix_blocks", F.explode(F.sequence(F.col("g") * GROUP, last)).alias("shard"))
        shards = shards.select("mix_id", "shard", F.least(F.lit(slots).cast("long"), F.col("mix_blocks") - F.col("shard") * slots).alias("slots"), "of")
        return settled(self._numbered(self._multinomials(shards, 0)), self.spark)

    def unreachable(self) -> DataFrame:
        """``mix_id, source``: targets that cannot be reached, max_repeats x tokens < target_share x tokens of the mix.

        The draws tell: a source falls short if its slots, drawn by target shares, go beyond its cap of blocks. Draws
        scatter by less than six deviations, and blocks are whole but for one of each part, so what is not beyond
        the cap by that much or below it is held against the exact tokens.
        """
        asked = self.first_draws.groupBy("mix_id", "source").agg(F.sum("n").alias("asked"))
        parts = self.parts.groupBy("source").agg(F.count("*").alias("parts"))
        own = self.capacity.join(asked, ["mix_id", "source"], "left").join(parts, "source", "left").fillna(0, ["asked", "parts"])
        share = F.least(F.greatest(F.col("target_share"), F.lit(0.0)), F.lit(1.0))
        rounding = F.col("max_repeats") * F.col("parts") + F.col("mix_parts")
        scatter = 6 * F.sqrt(F.col("mix_blocks") * share * (1 - share)) + rounding + 1
        own = own.withColumn("mix_parts", F.sum("parts").over(W.partitionBy("mix_id")))
        may = own.filter((F.col("target_share") > 0) & (F.col("asked") + scatter >= F.col("max_repeats") * F.col("blocks")))
        return may.filter(F.col("max_repeats") * F.col("tokens") < F.col("target_share") * F.col("mix_tokens")).select("mix_id", "source").distinct()

    @cached_property
    def drawn(self) -> DataFrame:
        """``mix_id, shard, source, n, blocks, before``: each shard's draws and those before it, to at most max_repeats x blocks.

        Slots that a source could not give are drawn once more among the sources of the mix that have blocks left.
        """
        first = self.first_draws
        taken = first.groupBy("mix_id", "source", "blocks", "cap").agg(F.sum("granted").alias("taken"))
        left = self.capacity.filter("source is not null and target_share > 0 and blocks > 0").join(taken.select("mix_id", "source", "taken"), ["mix_id", "source"], "left").fillna(0, ["taken"])
        left = left.withColumn("cap", F.coalesce(F.col("max_repeats").cast("long") * F.col("blocks"), F.lit(NO_CAP))).filter("cap > taken")
        of = left.groupBy("mix_id").agg(F.sort_array(F.collect_list(F.struct("source", "target_share", "blocks", "cap"))).alias("of"))
        short = first.groupBy("mix_id", "shard").agg(F.sum(F.col("n") - F.col("granted")).alias("slots")).filter("slots > 0").join(of, "mix_id")
        second = self._numbered(self._multinomials(short.select("mix_id", "shard", "slots", "of"), 1), left.select("mix_id", "source", "taken"))
        columns = ["mix_id", "shard", "source", F.col("granted").alias("n"), "blocks", "before"]
        return first.select(*columns).unionByName(second.select(*columns)).filter("n > 0")

    @cached_property
    def slotted(self) -> DataFrame:
        """``mix_id, shard, slot, source, use, block_no``: each slot with the block it takes and the how manieth use this is."""
        seed = self.seed
        each = self.drawn.select("mix_id", "shard", "source", "blocks", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("j"))
        each = each.select("mix_id", "shard", "source", "blocks", "j", F.floor(F.col("j") / F.col("blocks")).alias("use"))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                pdf = pdf.reset_index(drop=True)
                block = np.zeros(len(pdf), dtype=np.int64)
                for (source, use, n), rows in pdf.groupby(["source", "use", "blocks"]).indices.items():
                    block[rows] = permuted(pdf["j"].to_numpy()[rows] - use * n, int(n), _source_key(source, seed, int(use)))
                yield pd.DataFrame({"mix_id": pdf["mix_id"], "shard": pdf["shard"], "source": pdf["source"], "use": pdf["use"], "block_no": block})

        kind = self.targets.schema["mix_id"].dataType.simpleString()
        return each.mapInPandas(run, f"mix_id {kind}, shard long, source string, use long, block_no long")

    def mixed(self) -> DataFrame:
        """``mix_id, shard, source, use, block_no, doc_id, token_from, token_to``: the mix, as pieces of documents in blocks of shards."""
        return self.slotted.join(self.pieces(), ["source", "block_no"]).select("mix_id", "shard", "source", "use", "block_no", "doc_id", "token_from", "token_to")

    def shares(self) -> DataFrame:
        """``mix_id, source, target_share, drawn_tokens, actual_share, reachable``: what each source contributes to the mix drawn."""
        got = self.slotted.join(self.blocks, ["source", "block_no"]).groupBy("mix_id", "source").agg(F.sum("block_tokens").alias("drawn_tokens"))
        all_ = self.capacity.join(got, ["mix_id", "source"], "left").withColumn("drawn_tokens", F.coalesce("drawn_tokens", F.lit(0)).cast("long"))
        total = F.sum("drawn_tokens").over(W.partitionBy("mix_id"))
        short = F.col("max_repeats") * F.col("tokens") < F.col("target_share") * F.col("mix_tokens")
        return all_.select("mix_id", "source", "target_share", "drawn_tokens", F.when(total > 0, F.col("drawn_tokens") / total).otherwise(0.0).alias("actual_share"), (~short).alias("reachable"))
