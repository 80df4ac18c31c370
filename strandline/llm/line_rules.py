"""Quality rules: word statistics of each document and cross-document line frequency.

1. One pass over each whole text counts words, symbols, repeated lines and words in repeated 3-word windows, and
   hashes every distinct normalised line (lower case, digits as 0, single spaces) with the words it holds.
2. Documents are counted for each (host, line); a line is above its limit if more than MOST_DOCS documents of the host
   hold it, whatever the size of the host or of the table. Counts are aggregated before the shuffle; only lines above the
   limit go on.
3. A document loses those lines; it is depleted, and rejected, if it lost any and less than MIN_WORDS words or less
   than MIN_LEFT of its words are left.

Null text: no words. A null host is the host ''. Rows with equal ids are rows of their own. An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import stored, table, texts, with_order

#: The most documents of a host that may hold a line: six, as published for line deduplication of large web corpora.
MOST_DOCS = 6
MIN_WORDS, MIN_LEFT = 50, 0.5
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
_DIGITS = re.compile(rb"[0-9]")


def repeat_words(words: list[bytes]) -> int:
    """How many words lie in a 3-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered = np.zeros(len(words) + 3, np.int64)
    hit = np.flatnonzero(np.fromiter((count[w] > 1 for w in windows), bool, len(windows)))
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + 3, -1)
    return int((np.cumsum(covered) > 0).sum())


def line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(b" ".join(_DIGITS.sub(b"0", line.decode("utf-8", "replace").lower().encode()).split()))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, values in texts(batch.column(3), 1 << 20):
            part = batch.slice(i, j - i)
            stats, hashes, held = [], [], []
            for text in values:
                words = text.split()  # bytes: only \x20 and \x09-\x0D
                chars = sum(map(len, words))
                if not text.isascii():
                    chars -= int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
                seen: set[bytes] = set()
                lines: dict[int, int] = {}
                again = 0
                for line in text.split(b"\n"):
                    n = len(line.split())
                    if not n:
                        continue
                    if line in seen:
                        again += 1
                    seen.add(line)
                    h = line_hash(line)
                    lines[h] = lines.get(h, 0) + n
                stats.append((len(words), chars, sum(text.count(x) for x in SYMBOLS), again, repeat_words(words)))
                hashes.append(np.array(list(lines), np.uint64).view(np.int64))
                held.append(list(lines.values()))
            columns = list(zip(*stats, strict=True))
            ends = np.cumsum([0] + [len(x) for x in held]).astype(np.int32)
            of = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(hashes)))
            words_of = pa.ListArray.from_arrays(pa.array(ends), pa.array([y for x in held for y in x], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), *[pa.array(c, pa.int64()) for c in columns], of, words_of],
                names=["uid", "id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words"],
            )


def judge(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source", most_docs: int = MOST_DOCS
) -> DataFrame:
    """One row per row of docs: id, the statistics, base_failed, removed_words and kept."""
    base = with_order(docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text")), "id")
    kind = docs.schema[id_col].dataType.simpleString()
    measured = stored(
        base.select("uid", "id", F.coalesce("host", F.lit("")).alias("host"), "text").mapInArrow(
            _measure, f"uid long, id {kind}, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<int>"
        ),
        "lines",
    )
    lines = measured.select("uid", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("uid", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    above = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_docs).select("host", "line")
    lost = lines.join(above, ["host", "line"]).groupBy("uid").agg(F.sum("words").alias("removed_words"))
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    whole = (F.col("removed_words") == 0) | ((left >= MIN_WORDS) & (left >= MIN_LEFT * F.col("n_words")))
    return (
        measured.drop("lines", "line_words", "host").join(lost, "uid", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", failed).withColumn("kept", ~failed & whole).drop("uid")
    )


def op7_line_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP7_SQL = r"""
with d as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as t from documents), k as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from d),
wins as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as x from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from k where len(w) >= 3)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, x) as n from wins) where n > 1),
rep as (select doc_id, count(distinct i + o) as n_repeat_words from again, (select unnest([0, 1, 2]) as o) group by doc_id),
l as (select doc_id, host, line from (select doc_id, host, unnest(string_split(t, chr(10))) as line from d) where regexp_matches(line, '[^\x20\x09-\x0D]')),
dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from l group by doc_id),
norm as (select doc_id, host, array_to_string(regexp_extract_all(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[^\x20\x09-\x0D]+'), ' ') as x, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) as words from l group by all),
held as (select host, x, count(*) as n from norm group by host, x),
lost as (select doc_id, sum(words) as removed_words from norm join held using (host, x) where n > 6 group by doc_id),
s as (select k.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
  coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(removed_words, 0)::bigint as removed_words from k left join dup using (doc_id) left join rep using (doc_id) left join lost using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from s)
select *, not base_failed and (removed_words = 0 or (n_words - removed_words >= 50 and n_words - removed_words >= 0.5 * n_words)) as kept from f
"""
