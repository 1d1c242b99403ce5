"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line; its pieces are runs of ``PIECE`` space-separated words, so that an
edit in a long paragraph is placed as well.  A section ends with an empty line or after
``SECTION`` lines.  Digests go up from pieces to paragraphs, sections and the root, which
depends on every byte of the text.  The fingerprint holds the root and, below it, a short
code of every piece in the shape of the tree:

    root:section/section/...   section: paragraph,paragraph,...   paragraph: codes

Equal roots mean equal texts.  Where roots differ, only the sections, then the paragraphs,
then the pieces that differ are looked into.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import fit_blocks, pack, unpack

PIECE, SECTION = 4, 16
CODE = 4
_DIGEST = 16
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
_HEADS = "block int, wraps boolean, text string"


def _node(kind: bytes, children: list[bytes]) -> bytes:
    return hashlib.blake2b(b"".join(children), digest_size=_DIGEST, person=kind).digest()


def fingerprint(text: str | None) -> str:
    """Root and codes of a text; null counts as empty."""
    shape, roots, section, nodes = [], [], [], []

    def close() -> None:
        shape.append(",".join(section))
        roots.append(_node(b"section", nodes))
        section.clear()
        nodes.clear()

    for line in (text or "").encode("utf-8").split(b"\n"):
        words = line.split(b" ")
        leaves = [
            hashlib.blake2b(b" ".join(words[i : i + PIECE]), digest_size=_DIGEST).digest()
            for i in range(0, len(words), PIECE)
        ]
        nodes.append(_node(b"paragraph", leaves))
        section.append(base64.b64encode(b"".join([d[:3] for d in leaves]), b"-_").decode())
        if not line or len(section) == SECTION:
            close()
    if section:
        close()
    root = _node(b"root", roots).hex()
    return f"{root}:{'/'.join(shape)}"


def _codes(print_: str) -> Counter:
    tree = print_.partition(":")[2].replace("/", "").replace(",", "")
    return Counter([tree[i : i + CODE] for i in range(0, len(tree), CODE)])


def likeness(one: str, other: str) -> float:
    """1 for equal roots; else the share of pieces that both have, below 1 (Dice)."""
    return _likeness(one, _codes(one), other, _codes(other))


def _likeness(one: str, a: Counter, other: str, b: Counter) -> float:
    if one.partition(":")[0] == other.partition(":")[0]:
        return 1.0
    if len(b) < len(a):
        a, b = b, a
    common = sum([min(n, b[code]) for code, n in a.items() if code in b])
    total = a.total() + b.total()
    return 2 * common / (total + 1) if 2 * common == total else 2 * common / total


def differences(one: str, other: str) -> list[tuple[int, int]]:
    """(section, paragraph) of the paragraphs that differ or that only one text has; equal
    roots and sections are not looked into."""
    (root_a, _, a), (root_b, _, b) = one.partition(":"), other.partition(":")
    if root_a == root_b:
        return []
    found = []
    sections_a, sections_b = a.split("/"), b.split("/")
    for s in range(max(len(sections_a), len(sections_b))):
        x = sections_a[s] if s < len(sections_a) else None
        y = sections_b[s] if s < len(sections_b) else None
        if x == y:
            continue
        p, q = (x.split(",") if x is not None else []), (y.split(",") if y is not None else [])
        found += [
            (s, i)
            for i in range(max(len(p), len(q)))
            if (p[i] if i < len(p) else None) != (q[i] if i < len(q) else None)
        ]
    return found


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many of the first of
    the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _heads(count: int):
    """Sends the first text of a block to the block before it; that of the first block to
    the last.  The very last block may be empty, so the one before it is told as well."""

    def heads(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        text = unpack(table).column("text")[0].as_py()
        to = [(block - 1, False)] if block else [(count - 1, True), (count - 2, True)]
        to = [x for x in to if x[0] >= 0]
        return pa.table(
            {
                "block": pa.array([x[0] for x in to], pa.int32()),
                "wraps": pa.array([x[1] for x in to], pa.bool_()),
                "text": pa.array([text] * len(to), pa.string()),
            }
        )

    return heads


def _report(texts: pa.Table, heads: pa.Table) -> pa.Table:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    out: list[list] = [[] for _ in range(7)]
    if texts.num_rows:
        rows = unpack(texts)
        after = heads.sort_by("wraps").column("text")[0].as_py()
        ids = rows.column("doc_id").to_pylist()
        contents = [t or "" for t in rows.column("text").to_pylist()]
        own = fingerprint(contents[0])
        codes = _codes(own)
        for i, (doc_id, text) in enumerate(zip(ids, contents, strict=True)):
            last = i + 1 == len(contents)
            following = (after or "") if last else contents[i + 1]
            next_print = fingerprint(following)
            next_codes = _codes(next_print)
            changed = edited(text, following)
            changed_print = fingerprint(changed)
            values = (
                doc_id,
                len(text),
                hashlib.sha256(changed.encode("utf-8")).hexdigest(),
                own,
                changed_print,
                _likeness(own, codes, changed_print, _codes(changed_print)),
                _likeness(own, codes, next_print, next_codes),
            )
            for column, value in zip(out, values, strict=True):
                column.append(value)
            own, codes = next_print, next_codes
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    arrays = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
    return pa.table(arrays, names=[*names, "near_edited", "near_next"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``fingerprint`` (replaced if there is one); no shuffle."""
    return docs.withColumn("fingerprint", F.udf(fingerprint, "string", useArrow=True)("text"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): fingerprints of the text and of its
    edited text, and how like the first is to the second and to the next document's.

    The next document follows by ascending doc_id; after the last comes the first.  A null
    doc_id stands first, rows of one id follow each other by text.  A null text is empty,
    an empty text has one empty piece.  A table of one row follows itself; an empty table
    gives an empty one.
    """
    blocks = fit_blocks(docs)
    texts = pack(docs, blocks)
    heads = texts.groupBy("block").applyInArrow(_heads(blocks.count), _HEADS)
    return (
        texts.groupBy("block").cogroup(heads.groupBy("block")).applyInArrow(_report, RESULT)
    )
