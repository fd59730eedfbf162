"""Spelling variants among the words of all documents."""

import zlib

from faultlens.llm.registry import query, read
from faultlens.llm.variants import spelling_variants, word_counts

SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
  FROM documents),
per AS (SELECT doc_id, r, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (
  SELECT doc_id, r, k, flatten(list_transform(string_split(doc_id || ':' || r, ''),
         lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)) AS b
  FROM per),
hashed AS (
  SELECT r, k, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
less AS (SELECT word, n, unnest(list_transform(range(length(word)), lambda i: {'a': substr(word, 1, i), 'b': substr(word, i + 2)})) AS x FROM words),
pair AS (
  SELECT p.word AS u, q.word AS v FROM less p JOIN less q ON p.x = q.x AND p.word <> q.word
  UNION SELECT p.word, w.word FROM less p JOIN words w ON p.x.a || p.x.b = w.word
  UNION SELECT w.word, p.word FROM less p JOIN words w ON p.x.a || p.x.b = w.word),
near AS (SELECT u AS word, count(*) AS n_near, min({'m': -n, 'v': v}) AS best FROM pair JOIN words ON v = word GROUP BY u),
form AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 2 * w.n THEN best.v END AS form, CASE WHEN -best.m >= 2 * w.n THEN -best.m END AS form_n
  FROM words w LEFT JOIN near ON near.word = w.word),
walk AS (SELECT word, word AS at FROM form UNION ALL SELECT walk.word, f.form FROM walk JOIN form f ON f.word = walk.at WHERE f.form IS NOT NULL),
last AS (SELECT walk.word, walk.at AS root FROM walk JOIN form f ON f.word = walk.at WHERE f.form IS NULL)
SELECT f.word, f.form, last.root, f.n, f.n_near, f.form_n FROM form f JOIN last ON last.word = f.word
"""


def garbled(doc_id):
    """A function that takes one code point out of about every 97th word of a document; without an id none."""
    if doc_id is None:
        return lambda word: word
    start = zlib.crc32(f"{doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), start)
        if h % 97:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1:]

    return change


@query("op13_spelling_variants", SQL)
def op13_spelling_variants(spark, sf_dir):
    """Every word of the documents, some made wrong on purpose, with its form and root."""
    return spelling_variants(word_counts(read(spark, sf_dir, "documents"), garbled))
