"""N-gram Jaccard join with adaptive multi-match prefixes, and its groups.

A document is the set of its word shingles. Equal sets are one node. Two sets that reach the threshold share at
least l of the tokens in their l-prefixes: the first n - ceil(t n) + l tokens in one order that all sets follow.
The order is by estimated frequency, so prefixes hold rare tokens. A node picks its own l: the longer the prefix,
the more postings are read, but the more shared tokens a candidate must show; the estimated cost of both is least
at the l it takes. Two nodes with different l must share the smaller one.

Frequencies are counted over all documents in a table of fixed size (2^18 hash buckets), which orders tokens alike
everywhere and is all that is broadcast.

Groups of near copies would give all pairs of their members. Instead every node is first verified against one
leader, the node in its postings that has the largest share of its prefix in common with others; this takes at most one
pair a node. Then only candidates between different groups are left: per token, members outside its largest group
against all members. A pair inside a group would change no group.

Of two followers z and x of one leader b, the common tokens are at most min(|z & b|, |x & b|) and those that both have
beyond b. Where the first is too little, they are candidates only if they share a token beyond b, which is found by
a join of what followers have beyond their leaders. So the far members of a large group are not held against all of it.
Tokens with the same holders, as those of a common passage, are joined once. Verification is exact: on the whole sets,
or for followers of one leader on what each has beyond it and lacks of it.

Where the leader is itself a changed copy, its followers share much that it lacks. So before that join, rounds hold the
followers that share a token beyond it against the one nearest to it, which takes at most one pair a row. In the joins, two
followers of one leader must also have nearly the same bits (a few fixed words that mark what each has beyond it and lacks
of it): where bits differ, the sets do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.llm.graph import components
from barstream.llm.hashing import NOT_SPACE, Words, mix, shingle_sets, signed, text_slices
from barstream.llm.tables import drop_stored, free_name, record_batch, stored

BUCKET_BITS = 18
COUNTS_PER_ROW = 1 << 12
MAX_MATCHES = 6
SEEN_NODES = 100_000    # nodes a task remembers so as not to repeat a copy's prefix; more only cost repeats
VERIFY_COST = 0.05      # of one shingle in a verification, against reading one posting
FILTER_BITS = 23
TOKEN_BITS = 256
MAX_ROUNDS = 4          # of further leaders; what they leave is joined exactly
FOLLOW_MARGIN = 30      # a node that misses the threshold to its leader by more is compared as if it had none


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _node(tokens: np.ndarray) -> int:
    """64-bit hash of a whole set; n different sets collide with a chance of n^2 / 2^65."""
    place = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    return int(signed(mix(mix(tokens + place).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(tokens))))[0])


def _measure(size: int):
    """Every document's shingle count and node; at a task's end, its counts of shingle buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(2)):
                sets = shingle_sets(Words(data, offsets, NOT_SPACE), size)
                counts += np.bincount(_bucket(np.concatenate(sets)), minlength=len(counts))
                rows = last - first
                yield record_batch(
                    id=batch.column(0).slice(first, rows), content=batch.column(1).slice(first, rows),
                    n=pa.array([len(s) for s in sets], pa.int64()),
                    node=pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                    part=pa.nulls(rows, pa.int32()), counts=pa.nulls(rows, pa.binary()))
                id_type = batch.schema.field(0).type
        if counts.any():
            parts = [c.astype("<u1" if c.max() < 256 else "<u8").tobytes() for c in counts.reshape(-1, COUNTS_PER_ROW)]
            k = len(parts)
            yield record_batch(id=pa.nulls(k, id_type), content=pa.nulls(k, pa.int64()), n=pa.nulls(k, pa.int64()),
                               node=pa.nulls(k, pa.int64()), part=pa.array(range(k), pa.int32()), counts=pa.array(parts, pa.binary()))
    return run


def _counts_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u1" if len(raw) == COUNTS_PER_ROW else "<u8").astype(np.int64)


def _sum_counts(table: pa.Table) -> pa.Table:
    total = sum(_counts_of(c.as_py()) for c in table["counts"])
    return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "counts": pa.array([total.astype("<u8").tobytes()], pa.binary())})


def _bucket_counts(parts: DataFrame) -> np.ndarray:
    """All tasks' counts; summed in two steps, so no task gets those of all others. A fixed size for any corpus."""
    parts = parts.select("part", "counts", F.pmod(F.xxhash64("counts"), F.lit(64)).alias("salt"))
    partly = parts.groupBy("part", "salt").applyInArrow(_sum_counts, "part int, counts binary")
    rows = partly.groupBy("part").applyInArrow(_sum_counts, "part int, counts binary").collect()
    counts = np.zeros((1 << BUCKET_BITS) // COUNTS_PER_ROW * COUNTS_PER_ROW, np.int64).reshape(-1, COUNTS_PER_ROW)
    for row in rows:
        counts[row["part"]] = _counts_of(bytes(row["counts"]))
    return counts.ravel()


def adaptive_prefix(tokens: np.ndarray, counts: np.ndarray, usual: float, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set and the number of shared tokens it asks for.

    ``counts`` are bucket counts, ``usual`` what other tokens add to a bucket on average. Reading l-prefixes costs
    the postings in them; each candidate takes l of these, so there are at most postings / l to verify.
    """
    n = len(tokens)
    found = counts[_bucket(tokens)]
    order = np.lexsort((tokens, found))
    overlap = -(-percent * n // 100)
    most = min(MAX_MATCHES, overlap)
    lengths = n - overlap + np.arange(1, most + 1)
    postings = np.cumsum(np.maximum(found[order[:lengths[-1]]] - usual, 1.0))[lengths - 1]
    matches = int(np.argmin(postings * (1 + VERIFY_COST * n / np.arange(1, most + 1)))) + 1
    return tokens[order[:lengths[matches - 1]]], matches


def _prefixes(size: int, percent: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        usual = float(counts.mean())
        seen: set[int] = set()
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(0)):
                token, node, n, need, length = [], [], [], [], []
                for tokens in shingle_sets(Words(data, offsets, NOT_SPACE), size):
                    if not len(tokens) or (own := _node(tokens)) in seen:
                        continue
                    if len(seen) >= SEEN_NODES:
                        seen.clear()
                    seen.add(own)
                    prefix, matches = adaptive_prefix(tokens, counts, usual, percent)
                    token.append(signed(prefix)), node.append(np.full(len(prefix), own))
                    n.append(np.full(len(prefix), len(tokens), np.int32)), need.append(np.full(len(prefix), matches, np.int32))
                    length.append(np.full(len(prefix), len(prefix), np.int32))
                if token:
                    yield record_batch(token=np.concatenate(token), node=np.concatenate(node), n=np.concatenate(n), need=np.concatenate(need),
                                       length=np.concatenate(length))
    return run


def _texts(size: int, wanted):
    """(node, its text) of the texts whose content hash may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        seen: set[int] = set()
        for batch in batches:
            slot = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            passed = np.flatnonzero(bits[slot.astype(np.int64)])
            if not len(passed):
                continue
            texts = batch.column(1).take(pa.array(passed))
            for first, _, data, offsets in text_slices(texts):
                nodes, places = [], []
                for i, tokens in enumerate(shingle_sets(Words(data, offsets, NOT_SPACE), size), first):
                    if len(tokens) and (own := _node(tokens)) not in seen:
                        if len(seen) >= SEEN_NODES:
                            seen.clear()
                        seen.add(own)
                        nodes.append(own), places.append(i)
                if nodes:
                    yield record_batch(node=pa.array(nodes, pa.int64()), text=texts.take(pa.array(places)))
    return run


def _sets_of(nodes: pa.Array, texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each row's shingles; successive rows of one node share them."""
    nodes = nodes.to_numpy()
    begins = np.diff(nodes, prepend=~nodes[:1]) != 0
    sets = []
    for _, _, data, offsets in text_slices(texts.filter(pa.array(begins))):
        sets += shingle_sets(Words(data, offsets, NOT_SPACE), size)
    return [sets[i] for i in np.cumsum(begins) - 1]


def _bits(tokens: np.ndarray) -> np.ndarray:
    """``TOKEN_BITS`` bits, those of the tokens' slots set: where two sets' bits differ, one has a token that the other has not."""
    slots = np.zeros(TOKEN_BITS, bool)
    slots[(tokens % np.uint64(TOKEN_BITS)).astype(np.int64)] = True
    return np.packbits(slots).view(np.int64)


def _compared(size: int, follow: int):
    """Set sizes, common tokens, and what a has beyond b and lacks of it, of every pair; bits of the latter two together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_n, b_n, both, beyond, lacking, bits = [], [], [], [], [], []
            for x, y in zip(_sets_of(batch.column(0), batch.column(2), size), _sets_of(batch.column(1), batch.column(3), size)):
                place = np.searchsorted(y, x)
                place[place == len(y)] = 0
                found = y[place] == x
                a_n.append(len(x)), b_n.append(len(y)), both.append(int(found.sum()))
                follows = 100 * both[-1] >= follow * (len(x) + len(y) - both[-1])
                beyond.append(signed(x[~found]) if follows else [])
                lacking.append(signed(np.delete(y, place[found])) if follows else [])
                bits.append(_bits(np.concatenate([x[~found], np.delete(y, place[found])])) if follows else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(a_n, pa.int64()), pa.array(b_n, pa.int64()), pa.array(both, pa.int64()),
                 pa.array(beyond, pa.list_(pa.int64())), pa.array(lacking, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                names=["a", "b", "a_n", "b_n", "both", "beyond", "lacking", "bits"])
    return run


def _comparisons(pairs: DataFrame, read: DataFrame, contents: DataFrame, size: int, percent: int) -> DataFrame:
    """Exact comparisons (a, b, a_n, b_n, both, beyond, lacking, bits) of pairs of nodes."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    slots = (contents.join(nodes, "node").select(F.shiftrightunsigned("content", 64 - FILTER_BITS).alias("s"))
             .groupBy(F.shiftright("s", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("bits")).toArrow())
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[slots["word"].to_numpy()] = slots["bits"].to_numpy().view(np.uint64)
    wanted = read.sparkSession.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool))
    # Texts are moved, not shingles: these take several times the bytes.
    texts = (read.select("content", "text").mapInArrow(_texts(size, wanted), "node long, text string")
             .groupBy("node").agg(F.first("text").alias("text")))
    return (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
            .select("a", "b", "a_text", "b_text")
            .mapInArrow(_compared(size, percent - FOLLOW_MARGIN), "a long, b long, a_n long, b_n long, both long, beyond array<long>, lacking array<long>, bits array<long>"))


def _reaches(percent: int, both: Column, n: Column, m: Column) -> Column:
    """Whether ``both`` common tokens of sets of n and m are enough."""
    return both * (100 + percent) >= percent * (n + m)


def _near(x: str, y: str, percent: int) -> Column:
    """Whether two set sizes allow the threshold."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (..., token, node) with one token for all that have the same several holders, and the number of these."""
    holders = rows.groupBy(*keys).agg(F.struct(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("low"), F.max("node").alias("high")).alias("holders"))
    kept = holders.where("holders.n > 1").groupBy(*keys[:-1], "holders").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    return rows.join(kept.select(*keys, "weight"), keys)


def _across(rows: DataFrame, keys: list[str], percent: int, beyond: bool) -> DataFrame:
    """Pairs of nodes in different groups that share a key: members outside the key's largest group with all members.

    With ``beyond``, the keys are tokens beyond a leader: what two of its followers have of it in common, and the tokens
    beyond it, must be able to reach the threshold. Otherwise followers of one leader that need such tokens are left
    out, and the others must share enough keys.
    """
    members = rows.groupBy(*keys, "component").agg(F.count("*").alias("members"))
    largest = (members.groupBy(*keys).agg(F.max(F.struct("members", "component"))["component"].alias("largest"), F.count("*").alias("groups"))
               .where("groups > 1").select(*keys, "largest"))
    mixed = rows.join(largest, keys)
    fields = ["node", "n", "need", "component", "leader", "both", "bits"]
    side = lambda name: [F.col(f).alias(f"{name}_{f}") for f in fields]
    outside = mixed.where("component <> largest").select(*keys, "weight", *side("a"))
    inside = mixed.select(*keys, *side("b"), (F.col("component") == F.col("largest")).alias("b_largest"))
    pairs = (outside.join(inside, keys).where("a_component <> b_component")
             .where(F.col("b_largest") | (F.col("a_node") < F.col("b_node"))).where(_near("a_n", "b_n", percent)))
    ends = [F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")]
    of_leader = F.least("a_both", "b_both")
    enough = lambda common: _reaches(percent, common, F.col("a_n"), F.col("b_n"))
    # Followers of one leader differ in what one has beyond it or lacks of it and the other has not: at least where their bits do.
    differ = sum((F.bit_count(F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i])) for i in range(TOKEN_BITS // 64)), F.lit(0))
    alike = enough((F.col("a_n") + F.col("b_n") - differ) / 2)
    if beyond:
        most = of_leader + F.least(F.col("a_n") - F.col("a_both"), F.col("b_n") - F.col("b_both"))
        return (pairs.where(~enough(of_leader) & enough(most) & alike).groupBy(*ends, (F.col("a_n") + F.col("b_n")).alias("sizes"), of_leader.alias("of_leader"))
                .agg(F.sum("weight").alias("matches")).where(_reaches(percent, F.col("of_leader") + F.col("matches"), F.col("sizes"), F.lit(0))).select("a", "b"))
    hopeless = (F.col("a_leader") == F.col("b_leader")) & ~(enough(of_leader) & alike)
    return (pairs.where(~F.coalesce(hopeless, F.lit(False)))
            .groupBy(*ends, F.least("a_need", "b_need").alias("need")).agg(F.sum("weight").alias("matches"))
            .where("matches >= need").select("a", "b"))


def _links_of_followers(pairs: DataFrame, follows: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of followers of one leader that link, by what each has beyond the leader and lacks of it."""
    one = lambda name: follows.select(F.col("a").alias(name), F.col("a_n").alias(f"{name}_n"), F.col("b_n").alias("leader_n"),
                                      F.col("beyond").alias(f"{name}_beyond"), F.col("lacking").alias(f"{name}_lacking"))
    both = (F.col("leader_n") - F.size(F.array_union("a_lacking", "b_lacking"))
            + F.size(F.array_intersect("a_beyond", "b_beyond")))
    return (pairs.join(one("a"), "a").join(one("b").drop("leader_n"), "b")
            .where(_reaches(percent, both, F.col("a_n"), F.col("b_n"))).select("a", "b"))


def _next_leaders(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of a node outside a key's largest group and the most central member of that group: one a row at most."""
    by_group = rows.groupBy(*keys, "component").agg(F.count("*").alias("members"), F.max(F.struct("rank", "node")).alias("central"))
    largest = (by_group.groupBy(*keys).agg(F.max(F.struct("members", "component", "central")).alias("largest"), F.count("*").alias("groups"))
               .where("groups > 1").select(*keys, "largest"))
    return (rows.join(largest, keys).where(F.col("component") != F.col("largest.component"))
            .select(F.col("node").alias("a"), F.col("largest.central.node").alias("b"), "weight", "leader"))


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                       percent: int = 90) -> DataFrame:
    """Per row of ``documents``: id, n_shingles, component_id.

    Words are cut at white space after A-Z are lower-cased. A text of fewer words than a shingle is one shingle of
    all of them; null texts and texts without words are empty and linked with nothing, so their component is their
    own id. Two rows link if ``100 * intersection >= percent * union``. Rows with equal sets, repeated rows too, are
    linked. A null id is never the smallest; a component without other ids has a null one. An empty table gives no
    rows. Other columns are not read.
    """
    spark = documents.sparkSession
    read = documents.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("content"), F.col(text_col).alias("text"))
    id_type = documents.schema[id_col].dataType.simpleString()
    measured = stored(read.mapInArrow(
        _measure(shingle_words), f"id {id_type}, content long, n long, node long, part int, counts binary"), "measured")
    documents_of = measured.where("part is null").select("id", "content", "n", "node")
    counts = spark.sparkContext.broadcast(_bucket_counts(measured.where("part is not null")))
    prefixes = stored(read.select("text").mapInArrow(
        _prefixes(shingle_words, percent, counts), "token long, node long, n int, need int, length int"), "prefixes")
    shared = (prefixes.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .where("low <> high"))
    postings = prefixes.join(shared.select("token"), "token", "left_semi").distinct()
    # The share of a node's prefix that others have: near 1 in the text that copies were made from.
    central = postings.groupBy("node").agg(F.round(F.count("*") / F.max("length"), 2).alias("share"))
    postings = stored(postings.drop("length").join(central, "node"), "postings")
    drop_stored(prefixes)
    contents = documents_of.groupBy("node").agg(F.min("content").alias("content"))

    leaders = postings.groupBy("token").agg(F.max(F.struct("share", "node", "n")).alias("leader"))
    to_leader = (postings.join(leaders, "token").select("node", "n", F.col("leader.node").alias("leader"), F.col("leader.n").alias("leader_n"))
                 .where("node <> leader").where(_near("n", "leader_n", percent))
                 .groupBy("node", "leader").agg(F.count("*").alias("matches")))
    stars = to_leader.groupBy("node").agg(F.max(F.struct("matches", "leader"))["leader"].alias("leader"))
    stars = stored(stars.select(F.col("node").alias("a"), F.col("leader").alias("b")), "stars")
    compared = stored(_comparisons(stars, read, contents, shingle_words, percent), "compared")
    links = compared.where(_reaches(percent, F.col("both"), F.col("a_n"), F.col("b_n"))).select("a", "b")
    groups = components(links)

    follows = compared.where(100 * F.col("both") >= (percent - FOLLOW_MARGIN) * (F.col("a_n") + F.col("b_n") - F.col("both")))
    leader_of = follows.select(F.col("a").alias("node"), F.col("b").alias("leader"), "both", "bits")
    placed = lambda rows: rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # The nearer to its leader, the fewer changes of its own a follower has, so the nearer it is to the others.
    beyond = stored(_merged(stored(
        follows.select(F.col("a").alias("node"), F.col("b").alias("leader"), F.col("b").alias("by"), F.col("a_n").alias("n"), "both", "bits", F.lit(1).alias("need"),
                       (-F.size("beyond") - F.size("lacking")).alias("rank"), F.explode("beyond").alias("token")), "beyond"), ["by", "token"]), "beyond-merged")
    for _ in range(MAX_ROUNDS):
        nearer = _next_leaders(placed(beyond), ["by", "token"]).select("a", "b").distinct()
        more = stored(_links_of_followers(nearer, follows, percent), "more")
        if more.isEmpty():
            break
        links = stored(links.unionByName(more), "links")
        groups = components(links)

    of_nodes = stored(_merged(postings.withColumnRenamed("share", "rank").join(leader_of, "node", "left"), ["token"]), "postings-merged")
    across = stored(_across(placed(of_nodes), ["token"], percent, beyond=False).distinct(), "across")
    of_followers = _across(placed(beyond), ["by", "token"], percent, beyond=True)
    links = stored(links.unionByName(_links_of_followers(of_followers, follows, percent)), "links")
    if not across.isEmpty():
        found = _comparisons(across, read, contents, shingle_words, percent).where(_reaches(percent, F.col("both"), F.col("a_n"), F.col("b_n")))
        links = stored(links.unionByName(found.select("a", "b")), "links")
    groups = components(links)
    drop_stored(postings, compared, beyond, of_nodes, across)

    grouped = documents_of.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = grouped.where("group is not null").groupBy("group").agg(F.min("id").alias("least"))
    return grouped.join(least, "group", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def near_copies_removed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                        percent: int = 80) -> DataFrame:
    """One row of each group: the one with the smallest id, nulls last, and of equal ids the first; all columns kept. Texts
    without words are in no group and stay."""
    row = free_name(documents, "_row")
    numbered = stored(documents.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    ids = numbered.select(F.col(row).alias("row"), F.col(id_col).alias("id"))
    groups = stored(jaccard_components(numbered, row, text_col, shingle_words, percent).select(F.col(row).alias("row"), "component_id")
                    .join(ids, "row"), "row-groups")
    kept = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias(row))
    return numbered.join(kept.select(row), row, "left_semi").select(*documents.columns)
