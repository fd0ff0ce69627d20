"""Merkle manifest of a dataset, with a proof for every document.

Every document is a leaf; the leaves of a language, in id order, form a tree
of runs of eight, and the languages' subroots form the top tree.  The proof of
a leaf is the list of the other members of its run, of its parent's run, and
so on up to the root.

**Plan.**  Places come from range parts (``operators.ranking``), so a language
may hold any share of the rows.  Each tree level is one grouping of at most
eight rows a key.  Proofs are found by pointer jumping: a node's row holds an
ancestor and the sibling segments on the way to it, at first its parent; a
self-join of the table on *ancestor = node* doubles the distance and
concatenates the segments, until every row has reached the root, after
log2(depth) joins.  The eight leaves of a run share everything above the run,
so the run stands for them in the joins and its members are spread out at the
end.  A join's other side is only what can lie that far up, an eighth of an
eighth of the rows and so on; an ancestor is shared by 8^distance nodes at
most, evenly.  Digests travel as 32 bytes and are hashed as hex text.

Segments are pairs (left, right) of a run's other members, so a leaf can be
folded to the root: ``verify`` recomputes the root from any leaf digest.

Defined cases: a null field is hashed as ``-``; rows without an id come first
in their language; rows that share an id are ordered by their leaf; equal rows
are leaves of their own; a language with one document has that leaf as
subroot, a table with one language has its subroot as root, and a table of one
document has the leaf as root with an empty proof (sha256 of the empty text);
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalforge.llm.common import stored
from portalforge.operators.ranking import running_totals

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SEGMENTS = "array<struct<left:binary,right:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def _hash(text: Column) -> Column:
    """sha256 as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def leaf_digest(text: Column | None = None) -> Column:
    """The leaf of a document row; ``text`` in place of its own text."""
    def field(name: str) -> Column:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return _hash(F.concat(*[field(name) for name in FIELDS]))


def lowered_third() -> Column:
    """The leaf after tampering: where 3 divides the id's crc32 (an id is
    needed), the text's A-Z are lower-cased; else null."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(hit, leaf_digest(F.translate("text", UPPER, LOWER)))


def _node(tree: Column, level: int | Column, index: Column) -> Column:
    level = level if isinstance(level, Column) else F.lit(level)
    return F.concat_ws("/", level.cast("string"), index.cast("string"), tree)


def _run(index: Column) -> Column:
    return F.shiftright(index, 3)  # eight members


def _in_top(node: Column) -> Column:
    return node.rlike("^[0-9]+/[0-9]+/$")


def _climb(level_one: DataFrame, name: str, first: int) -> tuple[list[DataFrame], int]:
    """All levels above ``level_one`` (tree, index, id, digest, n): tables of
    parents with their ``kids``; and the number of the last level."""
    tables, level, nodes = [], first, level_one
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        level += 1
        run = _run(F.col("index"))
        grown = nodes.filter("n > 1").groupBy("tree", run.alias("up")).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("index", "id", "digest"))).alias("kids"))
        nodes = stored(grown.select(
            "tree", F.col("up").alias("index"), _node(F.col("tree"), level, F.col("up")).alias("id"),
            _hash(_joined(F.transform("kids", lambda k: k["digest"]))).alias("digest"),
            _run(F.col("n") + (ARITY - 1)).alias("n"), "kids"), f"{name}-{level}")
        tables.append(nodes)
    return tables, level


def _own_segment(kids: Column, at: Column) -> Column:
    """(left, right): the digests of the other members of a run."""
    digests = F.transform(kids, lambda k: k["digest"])
    empty = F.lit(b"")

    def bytes_of(part: Column) -> Column:
        return F.aggregate(part, empty, lambda a, d: F.concat(a, d))

    return F.struct(bytes_of(F.slice(digests, F.lit(1), at)).alias("left"),
                    bytes_of(F.slice(digests, at + 2, F.lit(ARITY))).alias("right"))


def _links(parents: DataFrame) -> DataFrame:
    """Every kid with its parent and the segment between them."""
    each = parents.select("id", "tree", "kids", F.posexplode("kids").alias("at", "kid"))
    crosses = F.col("tree") == ""  # a kid of another tree is a language's subroot
    return each.select(
        F.col("kid.id").alias("id"), F.col("id").alias("anc"), F.array(_own_segment(F.col("kids"), F.col("at"))).alias("path"),
        F.when(crosses & ~_in_top(F.col("kid.id")), F.col("kid.digest")).alias("subroot"))


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root (binary), ``path``
    (segments from the leaf up) and ``changed`` (a column over the documents
    computed in the same pass, null by default)."""
    changed = F.lit(None).cast("binary") if changed is None else changed
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))  # null first, then by bytes
    leaves = stored(docs.select("doc_id", tree.alias("tree"), leaf_digest().alias("digest"), changed.alias("changed"),
                                F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    placed = running_totals(leaves, group=["tree"], order=["doc_id", "digest", "row"], before="index", total="n")

    alone = F.col("n") == 1
    level = F.when(alone, 0).otherwise(1)
    up = F.when(alone, F.col("index")).otherwise(_run(F.col("index")))
    runs = stored(placed.groupBy("tree", up.alias("up")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("index", "digest", "doc_id", "changed"))).alias("kids")).select(
        "tree", F.col("up").alias("index"), _node(F.col("tree"), level, F.col("up")).alias("id"), alone.alias("alone"),
        F.when(alone, F.col("kids")[0]["digest"]).otherwise(_hash(_joined(F.transform("kids", lambda k: k["digest"])))).alias("digest"),
        F.when(alone, F.col("n")).otherwise(_run(F.col("n") + (ARITY - 1))).alias("n"), "kids"), "merkle-runs")

    nodes = runs.select("tree", "index", "id", "digest", "n")
    inner, height = _climb(nodes, "merkle", 1)
    tops = nodes
    for table in inner:
        tops = tops.unionByName(table.select(*nodes.columns))
    subroots = running_totals(tops.filter("n = 1").select(F.col("tree").alias("of"), "id", "digest"),
                              group=[], order=["of"], before="index", total="n")
    subroots = stored(subroots.select(F.lit("").alias("tree"), "index", "id", "digest", "n"), "merkle-subroots")
    outer, above = _climb(subroots, "merkle-top", 0)

    parents = [*inner, *outer]
    root = (outer[-1] if outer else subroots).select("id", "digest").first()
    root_id, root_digest = (root["id"], bytes(root["digest"])) if root else ("", b"")
    paths = runs.select("id", F.lit(None).cast("string").alias("anc"), F.array().cast(_SEGMENTS).alias("path"),
                        F.lit(None).cast("binary").alias("subroot")).limit(0)
    for table in parents:
        paths = paths.unionByName(_links(table))
    if parents:
        paths = stored(paths, "merkle-links")
    reach, distance = 1, height - 1 + above
    while reach < distance:
        far = paths.select(F.col("id").alias("anc"), F.col("anc").alias("anc2"), F.col("path").alias("path2"),
                           F.col("subroot").alias("subroot2"))
        far = far.filter((F.split("anc", "/")[0].cast("int") > reach) | _in_top(F.col("anc")))
        there = F.col("anc") == root_id
        further = paths.filter(~there).join(far, "anc").select(
            "id", F.col("anc2").alias("anc"), F.concat("path", "path2").alias("path"),
            F.coalesce("subroot", "subroot2").alias("subroot"))
        paths = stored(paths.filter(there).unionByName(further), "merkle-paths")
        reach *= 2

    none = F.array().cast(_SEGMENTS)
    to_root = runs.select("id", "alone", "kids").join(paths.select("id", "path", "subroot"), "id", "left")
    each = to_root.select("alone", "kids", "path", "subroot", F.posexplode("kids").alias("at", "kid"))
    own = F.when(F.col("alone"), none).otherwise(F.array(_own_segment(F.col("kids"), F.col("at"))))
    return each.select(F.col("kid.doc_id").alias("doc_id"), F.col("kid.digest").alias("leaf"),
                       F.coalesce("subroot", F.lit(root_digest)).alias("subroot"), F.lit(root_digest).alias("root"),
                       F.concat(own, F.coalesce("path", none)).alias("path"), F.col("kid.changed").alias("changed"))


def proof_text(path: Column) -> Column:
    """The siblings of a path, level by level and left to right, as hex text."""
    return F.array_join(F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf digest and its path give."""
    return F.aggregate(path, _hex(leaf), lambda digest, s: F.sha2(
        F.concat(_hex(s["left"]), digest, _hex(s["right"])).cast("binary"), 256))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of the untampered documents, and the root that each
    document's leaf after tampering gives."""
    rows = manifest(docs, lowered_third())
    folded = rows.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return folded.select("doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                         _hex(F.col("root")).alias("root"), F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == _hex(F.col("root"))).alias("verified"))
