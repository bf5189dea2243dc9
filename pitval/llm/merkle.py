"""A Merkle manifest of a table: per group a tree of fan-out 3 over its rows, and a tree over the groups.

Rows are leaves in the order of an id. While several nodes of a group remain, every three
consecutive ones (the last run may be shorter, even one) become the hash of their digests.
What remains is the group's subroot; the subroots, ordered by group, make the root alike.

Trees are swept by time-forward processing. A node's label is (level, index); a queue
ordered by label hands children's digests to their parent when its label comes up, and a
sweep in the reversed order hands each child its siblings and its parent's proof, until the
leaves have the whole of theirs. ``BLOCK_LEVELS`` levels over at most ``BLOCK`` neighbouring
nodes are one block with a queue in memory; messages between blocks are tables that Spark
shuffles to the block of their label, so the queue as a whole is external and a group of any
size is spread over many tasks. Five bands of blocks cover some 10^11 rows. Positions come from
a range partitioning and one count per partition and group, not from a window over a group.

A proof is a text: steps from the leaf up, joined by commas, each the node's place in its
run and the siblings' digests from left to right. ``folded`` recomputes the root from it.

Defined cases: a null field is ``-``, which no value is. A null group is a group of its own
and comes first, a null id comes first in its group. Rows with one id are ordered by their
digest; equal rows are leaves of their own. A group of one leaf has that leaf as subroot and
no step; a table of one group has its subroot as root. An empty table gives an empty
manifest. ``manifest`` carries any other columns along, whatever their names, but for those named
as its results, which it replaces; they don't count in the tree. Whole texts are hashed where
they are read, and don't move.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitval.llm.common import free_name, read
from pitval.operators.skew import place_in_order
from pitval.session import materialize

FAN = 3
BLOCK_LEVELS = 5
BLOCK = FAN**BLOCK_LEVELS
#: About so many nodes are one group of a Python task, so that small groups share its start-up.
TASK_NODES = 1024
DIGEST_CHARS = 64
RESULTS = ("proof", "subroot", "root")


def field(column: Column) -> Column:
    """``-`` for null, else the value's length in bytes, a colon and the value."""
    value = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def record_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


# ---- a block ------------------------------------------------------------------------


def levels_of(nodes: int) -> int:
    """Levels above ``nodes`` nodes."""
    made = 0
    while nodes > 1:
        nodes = -(-nodes // FAN)
        made += 1
    return made


def swept_up(first: int, digests: Sequence[str], levels: int) -> dict[tuple[int, int], str]:
    """Digests by label of a block whose lowest nodes have indices from ``first``."""
    nodes = {(0, first + k): d for k, d in enumerate(digests)}
    queue = [(1, index // FAN, index, d) for (_, index), d in nodes.items()] if levels else []
    while queue:
        level, index = queue[0][:2]
        run = []
        while queue and queue[0][:2] == (level, index):
            run.append(heapq.heappop(queue)[3])
        nodes[level, index] = made = hashlib.sha256("".join(run).encode()).hexdigest()
        if level < levels:
            heapq.heappush(queue, (level + 1, index // FAN, index, made))
    return nodes


def swept_down(nodes: dict[tuple[int, int], str], top: tuple[int, int], proof: str) -> dict[int, str]:
    """The proof of every lowest node, given that of the block's top."""
    queue, found = [(-top[0], -top[1], proof)], {}
    while queue:
        level, index, own = heapq.heappop(queue)
        level, index = -level, -index
        if not level:
            found[index] = own
            continue
        run = [(c, nodes[level - 1, c]) for c in range(FAN * index, FAN * index + FAN) if (level - 1, c) in nodes]
        for c, _ in run:
            step = str(c % FAN) + "".join(d for o, d in run if o != c)
            heapq.heappush(queue, (1 - level, -c, f"{step},{own}" if own else step))
    return found


def _blocks(table: pa.Table) -> Iterator[tuple[str, int, int, list[int], dict[tuple[int, int], str]]]:
    """Group, block number, nodes of the group, rows in order, and the block's nodes."""
    groups, places, sizes, digests = (table.column(n).to_pylist() for n in ("grp", "idx", "n", "digest"))
    order = sorted(range(len(groups)), key=lambda r: (groups[r], places[r]))
    for (group, block), rows in groupby(order, key=lambda r: (groups[r], places[r] // BLOCK)):
        rows = list(rows)
        size = sizes[rows[0]]
        nodes = swept_up(places[rows[0]], [digests[r] for r in rows], min(BLOCK_LEVELS, levels_of(size)))
        yield group, block, size, rows, nodes


# ---- the trees ----------------------------------------------------------------------


def _dealt(nodes: DataFrame, block: Column, tasks: int) -> DataFrame:
    return nodes.withColumn("task", F.pmod(F.xxhash64(F.col("grp"), block), F.lit(tasks)))


def _raised(nodes: DataFrame, tasks: int) -> DataFrame:
    """The tops of all blocks: the nodes of the next band."""

    def work(table: pa.Table) -> pa.Table:
        made = [(g, b, -(-n // BLOCK), nodes_[max(nodes_)]) for g, b, n, _, nodes_ in _blocks(table)]
        return pa.table({k: [row[i] for row in made] for i, k in enumerate(("grp", "idx", "n", "digest"))}, schema)

    schema = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
    own = nodes.select("grp", "idx", "n", "digest")
    dealt = _dealt(own, F.floor(F.col("idx") / BLOCK), tasks)
    return dealt.groupBy("task").applyInArrow(work, "grp string, idx long, n long, digest string")


def _lowered(nodes: DataFrame, messages: DataFrame, tasks: int) -> DataFrame:
    """``nodes`` with proof and roots; ``messages`` (grp, idx, proof, subroot, root) are for the tops of their blocks."""
    def work(table: pa.Table, told: pa.Table) -> pa.Table:
        sent = {(m["grp"], m["idx"]): m for m in told.to_pylist()}
        out = {k: [None] * table.num_rows for k in RESULTS}
        places = table.column("idx").to_pylist()
        for group, block, _, rows, found in _blocks(table):
            message = sent[group, block]
            proofs = swept_down(found, max(found), message["proof"])
            for r in rows:
                out["proof"][r], out["subroot"][r], out["root"][r] = proofs[places[r]], message["subroot"], message["root"]
        made = table.drop_columns(["task"])
        for k in RESULTS:
            made = made.append_column(k, pa.array(out[k], pa.string()))
        return made

    left = _dealt(nodes, F.floor(F.col("idx") / BLOCK), tasks).groupBy("task")
    right = _dealt(messages, F.col("idx"), tasks).groupBy("task")
    schema = ", ".join(f"`{n}` {t}" for n, t in nodes.dtypes) + ", proof string, subroot string, root string"
    return left.cogroup(right).applyInArrow(work, schema)


class Tree:
    """A tree for each group of ``nodes`` (grp, idx, n, digest, ...), which are written tables."""

    def __init__(self, nodes: DataFrame):
        self.bands, self.tasks, most = [nodes], [], None
        while most is None or most > 1:
            size = self.bands[-1].agg(F.count("*").alias("rows"), F.max("n").alias("most")).first()
            self.tasks.append(max(1, size["rows"] // TASK_NODES))
            self.bands.append(materialize(_raised(self.bands[-1], self.tasks[-1]), "tree-band"))
            most = -(-(size["most"] or 1) // BLOCK)

    def tops(self) -> DataFrame:
        """(grp, digest), a row for each group."""
        return self.bands[-1].select("grp", "digest")

    def proofs(self, messages: DataFrame) -> DataFrame:
        """The lowest nodes with proof, subroot and root; ``messages`` (grp, proof, subroot, root) are for the tops."""
        told = messages.withColumn("idx", F.lit(0).cast("long"))
        for band, tasks in zip(self.bands[-2::-1], self.tasks[::-1], strict=True):
            told = _lowered(band, told, tasks)
            if band is not self.bands[0]:
                told = materialize(told.select("grp", "idx", "proof", "subroot", "root"), "proofs")
        return told


def _placed(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` (grp, ...) with ``idx``, the place in the group, and ``n``, the group's rows; written."""
    # The scan's own numbering keeps rows apart that are equal in all else.
    told = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = place_in_order(told, ["grp", *order, "_row"], f"{label}-placed").withColumn("_part", F.shiftright("_slot", 33))
    sizes = placed.groupBy("grp", "_part").agg(F.count("*").alias("size"), F.min("_slot").alias("first"))
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "grp", "_part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
        F.sum("size").over(Window.partitionBy("grp")).alias("n"),
    )
    joined = placed.join(materialize(starts, f"{label}-starts"), ["grp", "_part"])
    return materialize(
        joined.withColumn("idx", F.col("offset") + F.col("_slot") - F.col("first")).select(*rows.columns, "idx", "n"), label
    )


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (id, grp, digest, ...) with proof, subroot and root.

    ``id`` orders the leaves of a group, ``grp`` may be null.
    """
    one = free_name("_one", leaves.columns)
    others = [F.col(f"`{c}`") for c in leaves.columns if c.lower() not in ("id", "grp", "digest", *RESULTS)]
    # One letter before the group, so that a null sorts before all and joins like a value.
    group = F.when(F.col("grp").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("grp").cast("string")))
    marked = leaves.select("id", group.alias("grp"), "digest", F.struct(F.lit(0).alias(one), *others).alias("others"))
    low = Tree(_placed(materialize(marked, "leaves"), ["id", "digest"], "leaf-places"))
    groups = low.tops().select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest")
    high = Tree(_placed(groups, ["member"], "group-places"))
    root = high.tops().select("grp", F.lit("").alias("proof"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    told = high.proofs(root).select(F.col("member").alias("grp"), "proof", F.col("digest").alias("subroot"), "root")
    found = low.proofs(materialize(told, "group-proofs"))
    own_group = F.when(F.col("grp") != "0", F.expr("substring(grp, 2)")).alias("grp")
    return found.select("id", own_group, "digest", "others.*", *RESULTS).drop(one)


def _steps(proof: Column) -> Column:
    return F.filter(F.split(proof, ","), lambda s: s != "")


def siblings(proof: Column) -> Column:
    """All digests of a proof, end to end."""
    return F.array_join(F.transform(_steps(proof), lambda s: F.substring(s, 2, 2 * DIGEST_CHARS)), "")


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""

    def up(own: Column, step: Column) -> Column:
        chars = F.substring(step, 1, 1).cast("int") * DIGEST_CHARS
        rest = F.substring(step, 2, 2 * DIGEST_CHARS)
        return F.sha2(F.concat(F.substring(rest, F.lit(1), chars), own, F.substring(rest, chars + 1, F.lit(2 * DIGEST_CHARS))), 256)

    return F.aggregate(_steps(proof), digest, up)


def verified(leaves: DataFrame, seen: str = "seen") -> DataFrame:
    """The manifest of ``leaves``, and whether the digest in ``seen`` still leads to the root."""
    made = manifest(leaves).withColumn("proof_sha256", F.sha2(siblings(F.col("proof")), 256))
    made = made.withColumn("folded_root", folded(F.col(seen), F.col("proof")))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op13(spark, folder):
    docs = read(spark, folder, "documents")
    own = [F.col(c) for c in COLUMNS]
    cut = [*own[:-1], F.replace(own[-1], F.lit("\n"), F.lit(""))]
    digest = record_digest(own)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    leaves = docs.select(
        F.col("doc_id").alias("id"), F.col("source").alias("grp"), digest.alias("digest"),
        F.when(tampered & F.contains(own[-1], F.lit("\n")), record_digest(cut)).alias("seen"),
    ).withColumn("seen", F.coalesce("seen", "digest"))
    return verified(leaves).select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


_FIELDS = " || ".join(
    f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in COLUMNS[:-1]
)
_CRC_BYTE = "list_reduce([xor(c, b)] || range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"


def _tree_sql(name: str, source: str) -> str:
    """CTEs: all nodes over ``source`` (grp, idx, n, digest), and what stands before and after each in its run."""
    return f"""{name}(level, grp, idx, n, digest) AS (
      SELECT 0::BIGINT, grp, idx, n, digest FROM {source}
      UNION ALL
      SELECT level + 1, grp, idx // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
      FROM {name} WHERE n > 1 GROUP BY level, grp, idx // 3),
    {name}_step AS (
      SELECT a.level, a.grp, a.idx,
             coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
             coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
      FROM {name} a JOIN {name} b ON a.level = b.level AND a.grp = b.grp AND a.idx // 3 = b.idx // 3
      WHERE a.n > 1 GROUP BY a.level, a.grp, a.idx)"""


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS grp, {_FIELDS} AS head, text,
         list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda c, b: {_CRC_BYTE}) AS crc
  FROM documents),
leaf AS (
  SELECT doc_id, grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n,
         sha256(head || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) AS digest,
         -- The CRC is the complement of what the bytes leave, so an odd rest is an even CRC.
         CASE WHEN crc & 1 = 1 THEN sha256(head || coalesce(octet_length(encode(replace(text, chr(10), '')))::VARCHAR || ':' || replace(text, chr(10), ''), '-')) END AS cut
  FROM d),
{_tree_sql('low', 'leaf')},
subroot AS (SELECT grp AS member, digest FROM low WHERE n = 1),
member AS (
  SELECT '' AS grp, member, row_number() OVER (ORDER BY encode(member)) - 1 AS idx, count(*) OVER () AS n, digest FROM subroot),
{_tree_sql('high', 'member')},
root AS (SELECT digest AS root FROM high WHERE n = 1),
path(doc_id, part, level, grp, idx, member, proof, digest) AS (
  SELECT doc_id, 0, 0::BIGINT, grp, idx, grp, '', coalesce(cut, digest) FROM leaf
  UNION ALL
  SELECT p.doc_id, x.part, x.level, x.grp, x.idx, p.member, x.proof, x.digest FROM path p LEFT JOIN low_step s
    ON p.part = 0 AND s.level = p.level AND s.grp = p.grp AND s.idx = p.idx
  LEFT JOIN high_step t ON p.part = 1 AND t.level = p.level AND t.idx = p.idx
  LEFT JOIN member m ON p.part = 0 AND m.member = p.grp,
  LATERAL (SELECT CASE WHEN p.part = 0 AND s.idx IS NULL THEN 1 WHEN p.part = 1 AND t.idx IS NULL THEN 2 ELSE p.part END AS part,
    CASE WHEN p.part = 0 AND s.idx IS NULL THEN 0 ELSE p.level + 1 END AS level,
    CASE WHEN p.part = 0 AND s.idx IS NULL THEN '' ELSE p.grp END AS grp,
    CASE WHEN p.part = 0 AND s.idx IS NULL THEN m.idx ELSE p.idx // 3 END AS idx,
    p.proof || coalesce(s.before || s.after, t.before || t.after, '') AS proof,
    CASE WHEN s.idx IS NOT NULL THEN sha256(s.before || p.digest || s.after)
         WHEN t.idx IS NOT NULL THEN sha256(t.before || p.digest || t.after) ELSE p.digest END AS digest) x
  WHERE p.part < 2)
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, root, sha256(p.proof) AS proof_sha256, p.digest AS folded_root,
       p.digest = root AS verified
FROM leaf l JOIN path p ON p.doc_id = l.doc_id AND p.part = 2 JOIN subroot s ON s.member = l.grp CROSS JOIN root
"""
