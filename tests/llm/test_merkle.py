import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from pursefold.llm import merkle, queries

SF = "/root/testdata/sf0.001"


def joined(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    values = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
    return joined(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([joined(*found[-1][k : k + 2]) for k in range(0, len(found[-1]), 2)])
    return found


def way(tree, at):
    """Siblings from a place to the top: (is it the left one, digest or None)."""
    found = []
    for level in tree[:-1]:
        other = at ^ 1
        found.append((other < at, level[other] if other < len(level) else None))
        at //= 2
    return found


def up(node, path):
    for left, other in path:
        node = joined(*([other, node] if left else [node, *([other] if other else [])]))
    return node


def plain(rows):
    """rows of doc_id, source, lang, n_chars, text."""
    tampered = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
    groups = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))) for g in groups}
    trees = {g: levels([plain_leaf(r) for r in members[g]]) for g in groups}
    top = levels([trees[g][-1][0] for g in groups])
    out = []
    for k, g in enumerate(groups):
        for at, r in enumerate(members[g]):
            path = way(trees[g], at) + way(top, k)
            folded = up(plain_leaf(r, int(tampered(r))), path)
            out.append((r[0], plain_leaf(r), trees[g][-1][0], top[-1][0], joined(*(h for _, h in path if h)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digested(docs, height):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.manifest(merkle.leaves(docs, {"n_chars": F.col("n_chars") + 1}, tampered), height)
    rows = found.select("id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof"), "version").collect()
    return sorted(((r.id, *(bytes(x).hex() for x in r[1:4]), r.proof, bytes(r.version).hex(), r.version == r.root) for r in rows), key=str)


def listed(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op13_merkle(spark, SF).select(*COLUMNS).collect()), key=str)
    assert got == plain(listed(docs))
    wrong = [r for r in got if not r[-1]]
    assert {r[0] for r in wrong} == {r[0] for r in got if zlib.crc32(str(r[0]).encode()) % 7 == 0} and wrong


@pytest.mark.parametrize("height", [1, 2, 3])
def test_manifest_over_several_levels_of_blocks(spark, height):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert digested(docs, height) == plain(listed(docs))


@pytest.mark.parametrize("height", [1, 10])
def test_manifest_of_odd_rows(spark, odd, height):
    names = [(f"l{k % 9}é", k) for k in range(30)]
    more = spark.createDataFrame([(k, None if k % 3 else "s", None if k % 5 == 0 else lang, None if k % 4 == 0 else k, "t") for lang, k in names], "doc_id long, source string, lang string, n_chars long, text string")
    docs = odd.withColumnsRenamed({"hash": "pos", "at": "total", "kept": "path"}).unionByName(more, allowMissingColumns=True)
    assert digested(docs, height) == plain(listed(docs))
    assert digested(docs.limit(1), height) == plain(listed(docs.limit(1)))
    assert digested(odd.filter("false"), height) == []


def test_all_rows_of_one_id(spark):
    docs = spark.range(300).selectExpr("7L doc_id", "'s' source", "'en' lang", "id % 3 n_chars", "'same' text")
    assert digested(docs, 4) == plain(listed(docs))


def test_a_version_shares_what_it_does_not_change():
    leaves = [bytes([k]) * 32 for k in range(11)]
    first = merkle.built(leaves, 4)
    second = merkle.replaced(first, 4, 6, b"x" * 32)
    third = merkle.replaced(second, 4, 10, b"y" * 32)

    def nodes(top):
        return {id(top): top} | (nodes(top[1]) if top[1] else {}) | (nodes(top[2]) if top[2] else {})

    assert len(nodes(second).keys() - nodes(first).keys()) == 5 and len(nodes(third).keys() - nodes(second).keys()) == 5
    assert first == merkle.built(leaves, 4)
    leaves[6] = b"x" * 32
    assert second == merkle.built(leaves, 4)
    leaves[10] = b"y" * 32
    assert third == merkle.built(leaves, 4)
