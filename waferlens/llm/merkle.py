"""A manifest of a dataset: digests of its rows, hashed up to one root, with proofs.

Every row is a leaf. The leaves of a group (a language), in order, are hashed in
runs of eight, the hashes again, until one is left; the groups' roots are hashed
up in the same way. What is stored are records from a digest to the digests of
its children, found by content alone: equal subtrees are stored once.

A proof is asked for by a leaf's rank. Requests start at the root and go down by
the digits of the rank to the base of eight: a join with the records of a height
gives the children, the digit selects one, the others are collected. Requests
with the same digits so far travel as one row and part where their digits do, so
a level moves no more rows than it has nodes that were asked for, and a third of
all leaves under one node are no hot key. The collected segments, reversed, are
the proof from the leaf up.

Ranks come from files sorted by group and id, counted file by file. Only a
record that many equal subtrees share could make a join uneven; those are
counted while equal records are merged, and go to all tasks apart (at most
20,000 by the way they are chosen).

Defined results: each null column has its own mark, distinct from any value;
null groups and null ids come first; rows of one group with one id go by digest,
so that repeated rows are leaves side by side; empty and very long texts are
hashed whole. Rows without an id are never tampered with. An empty table has no
rows and no root. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferlens.llm.common import BROADCAST_ROWS, join_bounded, staged
from waferlens.operators.ordering import global_rank

FAN = 8
DIGIT_BITS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Heights with up to so many records are broadcast; requests there stay in few tasks.
FEW_RECORDS = 1_000
# A record that stands for more equal subtrees than this may be hot.
HOT_COPIES = 1_000


def hashed(data: Column) -> Column:
    """The SHA-256 digest of text, in bytes."""
    return F.unhex(F.sha2(data, 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined(digests: Column) -> Column:
    """Digests as hex text, one after the other."""
    return F.array_join(F.transform(digests, hex_of), "")


def leaf_text(fields: Sequence[Column]) -> Column:
    """What a leaf's digest is taken of: for each field its size in bytes and its value."""
    texts = [f.cast("string") for f in fields]
    return F.concat(
        *(
            F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
            for t in texts
        )
    )


@dataclass(frozen=True)
class Manifest:
    """Staged tables of one dataset.

    ``leaves`` has the columns handed to ``build`` and tree, pos and size (the
    leaf's group, its rank in it, the leaves of the group); ``trees`` has tree,
    height and digest of each group's root; ``records`` has height, digest,
    children and copies, ``tops`` the same above the groups' roots.
    """

    leaves: DataFrame
    trees: DataFrame
    records: DataFrame
    tops: DataFrame
    height: int
    top_height: int
    root: bytes | None


def ranked(leaves: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``leaves`` with tree, pos and size, staged.

    Equal rows are told apart by their place, so that they spread over ranges too.
    """
    placed = leaves.withColumn("_row", F.monotonically_increasing_id())
    keys = [group, *order, "digest", "_row"]
    everywhere = staged(global_rank(placed, keys, "_rank", single_task_rows=0), "ranked")
    groups = global_rank(
        everywhere.groupBy(group).agg(F.min("_rank").alias("_first"), F.count("*").alias("size")),
        [group],
        "tree",
    )
    # Null is a group of its own: it joins as a mark beside an empty name.
    marks = {"_name": F.coalesce(F.col(group), F.lit("")), "_none": F.col(group).isNull()}
    found = join_bounded(
        everywhere.withColumns(marks),
        staged(groups.withColumns(marks).drop(group), "groups"),
        ["_name", "_none"],
        "inner",
    )
    return staged(
        found.withColumn("pos", F.col("_rank") - F.col("_first"))
        .withColumn("tree", F.col("tree") - 1)
        .select(*leaves.columns, "tree", "pos", "size"),
        "leaves",
    )


def levels_of(size: int) -> int:
    """How often ``size`` nodes are hashed in runs until one is left."""
    height = 0
    while size > 1:
        size, height = -(-size // FAN), height + 1
    return height


def hash_up(nodes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Records of all heights, equal ones once, and the root of each tree with its height.

    ``nodes`` has tree, pos, digest and size, the number of nodes of its tree,
    ``most`` at most.
    """
    height, runs = 0, []
    roots = nodes.where("size = 1").selectExpr("tree", "0 AS height", "digest")
    while most > 1:
        height, most = height + 1, -(-most // FAN)
        run = nodes.where("size > 1").groupBy(
            "tree", F.shiftright("pos", DIGIT_BITS).alias("pos")
        ).agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("run"),
            F.ceil(F.max("size") / FAN).alias("size"),
        )
        children = F.col("run.digest")
        level = staged(
            run.select("tree", "pos", "size", hashed(joined(children)).alias("digest"),
                       children.alias("children")),
            "level",
        )
        runs.append(level.select(F.lit(height).alias("height"), "digest", "children"))
        nodes = level.drop("children")
        roots = roots.union(nodes.where("size = 1").select("tree", F.lit(height), "digest"))
    if not runs:
        nothing = nodes.sparkSession.createDataFrame(
            [], "height int, digest binary, children array<binary>, copies long"
        )
        return nothing, roots
    every = runs[0]
    for more in runs[1:]:
        every = every.union(more)
    records = every.groupBy("height", "digest").agg(
        F.first("children").alias("children"), F.count("*").alias("copies")
    )
    return staged(records, "records"), roots


def build(leaves: DataFrame, group: str = "lang", order: Sequence[str] = ("doc_id",)) -> Manifest:
    """The manifest of rows that have a ``digest`` (in bytes), a ``group`` and ``order`` columns."""
    found = ranked(leaves, group, order)
    sizes = found.groupBy("tree").agg(F.first("size").alias("size"))
    facts = sizes.agg(F.max("size"), F.count("*")).first()
    most, groups = facts[0] or 0, facts[1]
    records, roots = hash_up(found.select("tree", "pos", "digest", "size"), most)
    trees = staged(roots, "trees")
    crowns = trees.select(
        F.lit(0).alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(groups).alias("size")
    )
    tops, top = hash_up(crowns, groups)
    last = top.first()
    return Manifest(
        found, trees, records, tops, levels_of(most), levels_of(groups), last and bytes(last["digest"])
    )


def _down(rows: DataFrame, records: DataFrame, height: int, facts: dict) -> DataFrame:
    """Each row of a node of this height with the ``children`` of its record."""
    count, places = facts.get(height, (0, 0))
    level = records.where(F.col("height") == height).select("digest", "children", "copies")
    if count <= FEW_RECORDS:
        return rows.join(F.broadcast(level.drop("copies")), "digest")
    most = max(HOT_COPIES, places // BROADCAST_ROWS)
    hot = level.where(F.col("copies") > most).drop("copies")
    if hot.isEmpty():
        return rows.join(level.drop("copies"), "digest")
    rows = staged(rows, "requests")
    cold = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    return rows.join(F.broadcast(hot), "digest").unionByName(
        cold.join(level.where(F.col("copies") <= most).drop("copies"), "digest")
    )


def _others(digit: Column) -> Column:
    """A segment: the digit taken, and the children that were not."""
    return F.struct(
        digit.cast("int").alias("digit"),
        F.filter("children", lambda child, at: at != digit).alias("others"),
    )


def _parted(rows: DataFrame) -> DataFrame:
    """One row for each child, its place, and the path with the children beside it."""
    kept = [c for c in rows.columns if c not in ("digest", "children", "pos", "path")]
    step = rows.select(*kept, "pos", "path", "children", F.posexplode("children").alias("_digit", "digest"))
    return step.select(
        *kept,
        (F.shiftleft("pos", DIGIT_BITS) + F.col("_digit")).alias("pos"),
        "digest",
        F.concat("path", F.array(_others(F.col("_digit")))).alias("path"),
    )


def _facts(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Records and places of each height; a handful of rows."""
    rows = records.groupBy("height").agg(F.count("*"), F.sum("copies")).collect()
    return {row[0]: (row[1], row[2]) for row in rows}


def _asked(rows: DataFrame, requests: DataFrame | None, height: int, place: str, *keys: str) -> DataFrame:
    """Only nodes of this height above a request; all if there is no list of requests."""
    if requests is None:
        return rows
    wanted = requests.select(*keys, F.shiftright(place, DIGIT_BITS * height).alias("pos")).distinct()
    return rows.join(wanted, [*keys, "pos"], "left_semi")


def descend(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The last but one node on the way to each leaf asked for: tree, run, children, path, subroot.

    ``requests`` has tree and pos, each pair once or more often; without it all
    leaves are asked for. ``path`` holds the segments from the root down.
    """
    spark: SparkSession = manifest.leaves.sparkSession
    start = spark.createDataFrame([(0, manifest.root)], "pos long, digest binary")
    rows = start.withColumn("path", F.expr("CAST(array() AS array<struct<digit:int,others:array<binary>>>)"))
    facts = _facts(manifest.tops)
    for height in range(manifest.top_height, 0, -1):
        rows = _parted(_down(rows, manifest.tops, height, facts))
        rows = _asked(rows, requests, height - 1, "tree")
    # The digits of the group are used up: each row is at a group's root now.
    roots = staged(
        rows.withColumnRenamed("pos", "tree")
        .join(manifest.trees.select("tree", "height"), "tree")
        .select("tree", F.lit(0).cast("long").alias("pos"), "digest", "path",
                F.col("digest").alias("subroot"), "height"),
        "crowns",
    )
    facts, rows = _facts(manifest.records), roots.where("height < 0").drop("height")
    for height in range(manifest.height, 1, -1):
        rows = rows.union(roots.where(F.col("height") == height).drop("height"))
        rows = _parted(_down(rows, manifest.records, height, facts)).select(rows.columns)
        rows = _asked(rows, requests, height - 1, "pos", "tree")
    rows = rows.union(roots.where("height = 1").drop("height"))
    lone = roots.where("height = 0").withColumn("children", F.lit(None).cast("array<binary>"))
    columns = ["tree", F.col("pos").alias("run"), "children", "path", "subroot"]
    return _down(rows, manifest.records, 1, facts).select(*columns).union(lone.select(*columns))


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaves asked for with ``path`` (segments from the leaf up), ``subroot`` and ``root``.

    ``requests`` as for ``descend``; a request for a leaf that is not there gives no row.
    """
    asked = manifest.leaves
    if requests is not None:
        asked = asked.join(requests.select("tree", "pos").distinct(), ["tree", "pos"], "left_semi")
    if manifest.root is None:
        empty = "array<struct<digit:int,others:array<binary>>>"
        return asked.withColumns(
            {"path": F.lit(None).cast(empty), "subroot": F.col("digest"), "root": F.col("digest")}
        )
    runs = descend(manifest, requests)
    digit = F.col("pos").bitwiseAND(FAN - 1)
    down = F.when(F.col("children").isNull(), F.col("path")).otherwise(
        F.concat("path", F.array(_others(digit)))
    )
    return (
        asked.withColumn("run", F.shiftright("pos", DIGIT_BITS))
        .join(runs, ["tree", "run"])
        .select(*manifest.leaves.columns, F.reverse(down).alias("path"), "subroot",
                F.lit(manifest.root).alias("root"))
    )


def proof_text(path: Column) -> Column:
    """All digests of a proof as hex text, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda s: joined(s["others"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""

    def up(digest: Column, segment: Column) -> Column:
        others, digit = segment["others"], segment["digit"]
        left = F.slice(others, F.lit(1), digit)
        right = F.slice(others, digit + 1, F.lit(FAN))
        return hashed(F.concat(joined(left), hex_of(digest), joined(right)))

    return F.aggregate(path, leaf, up)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Id, group and digest of each document, and the digest after tampering (else null)."""
    fields = [F.col(c) for c in FIELDS]
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    lowered = F.translate("text", upper, upper.lower())
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        hashed(leaf_text(fields)).alias("digest"),
        F.when(changed, hashed(leaf_text([*fields[:-1], lowered]))).alias("tampered"),
    )


def verify_documents(docs: DataFrame) -> DataFrame:
    """Every document's proof against the manifest of all, after some were tampered with."""
    proofs = prove(build(document_leaves(docs)))
    root = folded(F.coalesce("tampered", "digest"), F.col("path"))
    return proofs.select(
        "doc_id",
        hex_of(F.col("digest")).alias("leaf"),
        hex_of(F.col("subroot")).alias("subroot"),
        hex_of(F.col("root")).alias("root"),
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        hex_of(root).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_levels(name: str, start: str, levels: int) -> tuple[str, str]:
    """CTEs that hash up the nodes of ``start``, and the rows of all roots."""
    ctes, nodes = [], start
    roots = [f"SELECT tree, digest FROM {start} WHERE size = 1"]
    for k in range(1, levels + 1):
        ctes.append(f"""{name}_runs{k} AS MATERIALIZED (
    SELECT tree, pos // {FAN} AS pos, list(digest ORDER BY pos) AS children,
        (max(size) + {FAN - 1}) // {FAN} AS size
    FROM {nodes} WHERE size > 1 GROUP BY tree, pos // {FAN})""")
        nodes = f"{name}_nodes{k}"
        ctes.append(f"""{nodes} AS MATERIALIZED (
    SELECT tree, pos, size, sha256(array_to_string(children, '')) AS digest FROM {name}_runs{k})""")
        roots.append(f"SELECT tree, digest FROM {nodes} WHERE size = 1")
    return ",\n".join(ctes), " UNION ALL ".join(roots)


def _sql_climb(name: str, start: str, levels: int) -> str:
    """CTEs that add the siblings of each level to the proof and fold them."""
    ctes, before = [], start
    for k in range(1, levels + 1):
        here = f"{name}_climb{k}"
        ctes.append(f"""{here} AS MATERIALIZED (
    SELECT p.* REPLACE (
        CASE WHEN children IS NULL THEN p.pos ELSE p.pos // {FAN} END AS pos,
        proof || coalesce(array_to_string(children[1 : p.pos % {FAN}], ''), '')
              || coalesce(array_to_string(children[p.pos % {FAN} + 2 :], ''), '') AS proof,
        CASE WHEN children IS NULL THEN folded ELSE sha256(
            coalesce(array_to_string(children[1 : p.pos % {FAN}], ''), '') || folded
            || coalesce(array_to_string(children[p.pos % {FAN} + 2 :], ''), '')) END AS folded)
    FROM {before} p LEFT JOIN {name}_runs{k} r ON r.tree = p.tree AND r.pos = p.pos // {FAN})""")
        before = here
    return ",\n".join(ctes)


def sql(levels: int = 8, top_levels: int = 3) -> str:
    """The same in DuckDB's SQL, for groups of up to 8 ** levels rows and 8 ** top_levels groups."""

    def leaf(text: str) -> str:
        fields = [f"CAST({f} AS VARCHAR)" for f in FIELDS[:-1]] + [text]
        return " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)

    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    low, low_roots = _sql_levels("low", "leaves", levels)
    top, top_roots = _sql_levels("top", "crowns", top_levels)
    # 3988292384 is the reversed polynomial of CRC-32.
    crc = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
        lambda a, c: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
            lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(a, c)),
        4294967295::BIGINT), 4294967295::BIGINT)"""
    return f"""WITH hashed AS MATERIALIZED (
    SELECT doc_id, lang, sha256({leaf("text")}) AS digest,
        CASE WHEN {crc} % 3 = 0
            THEN sha256({leaf(f"translate(text, '{upper}', '{upper.lower()}')")}) END AS tampered
    FROM documents),
leaves AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS size
    FROM hashed),
{low},
subroots AS MATERIALIZED ({low_roots}),
crowns AS MATERIALIZED (
    SELECT 0 AS tree, tree AS pos, digest, (SELECT count(*) FROM subroots) AS size FROM subroots),
{top},
roots AS ({top_roots}),
low_climb0 AS (
    SELECT tree, pos, doc_id, digest AS leaf, '' AS proof, coalesce(tampered, digest) AS folded FROM leaves),
{_sql_climb("low", "low_climb0", levels)},
top_climb0 AS (
    SELECT 0 AS tree, c.tree AS pos, doc_id, leaf, s.digest AS subroot, proof, folded
    FROM low_climb{levels} c JOIN subroots s ON s.tree = c.tree),
{_sql_climb("top", "top_climb0", top_levels)}
SELECT doc_id, leaf, subroot, roots.digest AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = roots.digest AS verified
FROM top_climb{top_levels} CROSS JOIN roots"""


def brute_force(rows: list) -> list:
    """The same one by one, for tests: rows of (doc_id, source, lang, n_chars, text)."""
    import hashlib
    import zlib

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def leaf(row: tuple) -> str:
        texts = [None if v is None else str(v) for v in row]
        return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))

    def climb(nodes: list[str], at: int) -> tuple[str, list[tuple[list[str], list[str]]]]:
        path = []
        while len(nodes) > 1:
            run = nodes[at // FAN * FAN : at // FAN * FAN + FAN]
            path.append((run[: at % FAN], run[at % FAN + 1 :]))
            nodes = [sha("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
            at //= FAN
        return nodes[0], path

    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, leaf(row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for members in groups.values():
        members.sort(key=lambda m: (m[0][0] is not None, m[0][0] or 0, m[1]))
    crowns = [climb([m[1] for m in groups[g]], 0)[0] for g in names]
    out = []
    for place, name in enumerate(names):
        nodes = [m[1] for m in groups[name]]
        root, above = climb(crowns, place)
        for at, (row, own) in enumerate(groups[name]):
            path = climb(nodes, at)[1] + above
            proof = sha("".join("".join(left + right) for left, right in path))
            now = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                now = leaf((*row[:4], low))
            for left, right in path:
                now = sha("".join(left) + now + "".join(right))
            out.append((row[0], own, crowns[place], root, proof, now, now == root))
    return out
