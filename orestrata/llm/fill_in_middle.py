"""Fill-in-the-middle texts by secondary sort: pieces keyed by document and output position, streamed into digests.

A text is cut into units (lines); two draws from a hash of its doc_id cut the units into prefix, middle and suffix, a third
says whether it is transformed at all, a fourth in which form: psm, ``<P>prefix<S>suffix<M>middle``, or spm,
``<S>suffix<P>prefix<M>middle``. Texts that hold a mark themselves stay plain, so marks in an output are never ambiguous.

1. **Emit.** Each document gives a head row and pieces, each a run of whole units of at most ``PIECE_CHARS`` characters (a
   longer unit is cut), keyed by the document's row and its place in the output. Nothing is put together here.
2. **Assemble.** One repartition by row with a sort by (row, place) within partitions. A task sees the pieces of a document
   in output order and passes them through an incremental digest, one piece in memory at a time.
3. **Restore.** The same pass reads the marks in the stream, as a reader of the output would, and gives every piece its
   place in the text again. A second sort within the same partitions, without a shuffle, brings them into that order for
   the second digest.

Rows are told apart by their number in the scan, not by doc_id, so that rows without an id or with the same are spread as any
others. A table that comes out of a shuffle should be written first, so that a task that runs again numbers its rows alike.

Defined results: null text is empty; an empty text is plain with n = 0 and the digest of nothing; a null doc_id draws from the
hash of the seed and an empty id; repeated rows are transformed once each; an empty table gives no rows. Other columns are
not looked at.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.common import text_of
from orestrata.session import in_arrow

#: The contract's marks, and the section that each begins, by its place in the text.
MARKS = {"prefix": "<P>", "middle": "<M>", "suffix": "<S>"}
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
SECTIONS = ("prefix", "middle", "suffix")
_ANY_MARK = re.compile("|".join(MARKS.values()))
_MARK_BYTES = re.compile(b"|".join(m.encode() for m in MARKS.values()))
_SECTION_OF = {m.encode(): SECTIONS.index(s) for s, m in MARKS.items()}
SEED = 7
RATE = 100
SPM_SHARE = 50
PIECE_CHARS = 16_384
#: Characters that a batch of emitted pieces holds, at least one piece.
BATCH_CHARS = 4_000_000
#: The head row of a document stands before its pieces.
HEAD = -1
HEADS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = f"row long, place long, piece binary, {HEADS}"
_KINDS = {"row": pa.int64(), "place": pa.int64(), "piece": pa.binary(), "doc_id": pa.int64(), "n": pa.int64(), "form": pa.string(),
          "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output_sha256": pa.string(), "restored_sha256": pa.string(), "text": pa.string()}


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The four draws of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def unit_end(text: str, units: int) -> int:
    """Where the first ``units`` units of the text end."""
    at = 0
    for _ in range(units):
        at = text.find("\n", at) + 1
        if not at:
            return len(text)
    return at


def pieces(text: str, start: int, end: int, most: int) -> Iterator[str]:
    """Runs of whole units of at most ``most`` characters; a longer unit is cut."""
    while end - start > most:
        stop = text.rfind("\n", start, start + most) + 1
        stop = stop if stop > start else start + most
        yield text[start:stop]
        start = stop
    if start < end:
        yield text[start:end]


def transformed(doc_id: int | None, text: str, seed: int, rate: int, spm_share: int, most: int) -> Iterator[tuple]:
    """(place, piece, n, form, prefix_chars, middle_chars): the head first, then the pieces in output order."""
    n = text.count("\n") + (text[-1:] not in ("", "\n"))
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or _ANY_MARK.search(text):
        yield HEAD, None, n, "plain", None, None
        for place, piece in enumerate(pieces(text, 0, len(text), most)):
            yield place, piece.encode(), None, None, None, None
        return
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = unit_end(text, low), unit_end(text, high)
    form = "spm" if h4 % 100 < spm_share else "psm"
    spans = {"prefix": (0, first), "middle": (first, second), "suffix": (second, len(text))}
    yield HEAD, None, n, form, first, second - first
    place = 0
    for section in FORMS[form]:
        mark = MARKS[section]
        for piece in pieces(text, *spans[section], most):
            yield place, (mark + piece).encode(), None, None, None, None
            mark, place = "", place + 1
        if mark:
            yield place, mark.encode(), None, None, None, None
            place += 1


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _KINDS[n]) for i, n in enumerate(names)], names)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _rows(batches: Iterator[pa.RecordBatch], take: tuple[str, ...]) -> Iterator[tuple]:
    """Rows of sorted batches, a few at a time, so that no more than one batch is in memory."""
    for batch in batches:
        columns = [batch.column(n) for n in take]
        for at in range(0, batch.num_rows, 64):
            yield from zip(*[c.slice(at, 64).to_pylist() for c in columns], strict=True)


def output_pieces(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE, piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """The outputs as pieces: row, place (-1: the head, with doc_id, n, form, prefix_chars, middle_chars), piece (UTF-8);
    all rows of a document in one partition, in output order."""
    names = _names(PIECES)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n_chars = [], 0
            for row, doc_id, text in _rows([batch], ("row", "doc_id", "text")):
                for place, piece, *head in transformed(doc_id, text, seed, rate, spm_share, piece_chars):
                    held.append((row, place, piece, doc_id if piece is None else None, *head))
                    n_chars += len(piece or b"")
                    if n_chars > BATCH_CHARS:
                        yield _batch(held, names)
                        held, n_chars = [], 0
            if held:
                yield _batch(held, names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    return numbered.transform(in_arrow, emit, PIECES).repartition("row").sortWithinPartitions("row", "place")


def fill_in_middle(docs: DataFrame, **options) -> DataFrame:
    """The transformed documents: doc_id, text (the output), n, form, prefix_chars, middle_chars."""
    schema = "doc_id long, text string, n long, form string, prefix_chars long, middle_chars long"
    names = _names(schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple | None = None
        parts: list[bytes] = []
        held, size = [], 0
        for place, piece, *own in _rows(batches, ("place", "piece", *_names(HEADS))):
            if place == HEAD:
                if head is not None:
                    held.append((head[0], b"".join(parts).decode(), *head[1:]))
                    if size > BATCH_CHARS:
                        yield _batch(held, names)
                        held, size = [], 0
                head, parts = tuple(own), []
            else:
                parts.append(piece)
                size += len(piece)
        if head is not None:
            held.append((head[0], b"".join(parts).decode(), *head[1:]))
            yield _batch(held, names)

    return output_pieces(docs, **options).transform(in_arrow, join, schema)


def restored_pieces(outputs: DataFrame) -> DataFrame:
    """``output_pieces`` in the order of the texts that they were made of, without marks, still in their partitions; the heads
    have the digest of the output. Only the outputs' bytes and their form decide the places."""
    schema = f"{PIECES}, output_sha256 string"
    names = _names(schema)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple | None = None
        digest, section, count = None, 0, 0
        held, size = [], 0

        def ended() -> None:
            if head is not None:
                held.append((head[0], HEAD, None, *head[1:], digest.hexdigest()))

        for row, place, piece, *own in _rows(batches, ("row", "place", "piece", *_names(HEADS))):
            if place == HEAD:
                ended()
                head, digest, section, count = (row, *own), hashlib.sha256(), 0, 0
                continue
            digest.update(piece)
            at = 0
            if head[3] != "plain":
                for mark in _MARK_BYTES.finditer(piece):
                    if mark.start() > at:
                        held.append((row, (section << 40) + count, piece[at : mark.start()], *[None] * 6))
                        count += 1
                    section, at = _SECTION_OF[mark.group()], mark.end()
            if at < len(piece):
                held.append((row, (section << 40) + count, piece[at:], *[None] * 6))
                count += 1
            size += len(piece)
            if size > BATCH_CHARS:
                yield _batch(held, names)
                held, size = [], 0
        ended()
        if held:
            yield _batch(held, names)

    return outputs.transform(in_arrow, restore, schema).sortWithinPartitions("row", "place")


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every document."""
    schema = f"{HEADS}, output_sha256 string, restored_sha256 string"
    names = _names(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple | None = None
        whole = None
        held: list[tuple] = []
        for place, piece, *own in _rows(batches, ("place", "piece", *_names(HEADS), "output_sha256")):
            if place != HEAD:
                whole.update(piece)
                continue
            if head is not None:
                held.append((*head, whole.hexdigest()))
            head, whole = tuple(own), hashlib.sha256()
            if len(held) >= 10_000:
                yield _batch(held, names)
                held = []
        if head is not None:
            held.append((*head, whole.hexdigest()))
            yield _batch(held, names)

    return restored_pieces(output_pieces(docs, **options)).transform(in_arrow, digest, schema)


def op12_fill_in_middle(spark, sf_dir):
    from orestrata.llm.common import table

    return digests(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), s AS (
  SELECT *, coalesce(array_to_string(u[1:least(a, b)], ''), '') AS p,
         coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
         coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS x
  FROM c
), o AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END AS o
  FROM s
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(o) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN o WHEN 'psm' THEN regexp_replace(o, '^<P>(.*)<S>(.*)<M>(.*)$', '\1\3\2', 's')
              ELSE regexp_replace(o, '^<S>(.*)<P>(.*)<M>(.*)$', '\2\3\1', 's') END) AS restored_sha256
FROM o
"""
