
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordweave.functions.text import LINES_PER_DOCUMENT
from wordweave.functions.threshold import Threshold
from wordweave.operators import inverted_index as idx
from wordweave.operators import line_sets as ls
from wordweave.operators import similarity as sim
from wordweave.operators import terms
from wordweave.operators.tokens import lines
from wordweave.plans import index_jobs, similarity_jobs
from wordweave.operators.tokens import tokens
from wordweave.shared import new_path, save
from wordweave.sinks import (
    metric_rows,
    write_delimited,
    write_index,
    write_line_sets,
    write_packed_documents,
    write_text_folders,
)
from wordweave.sinks.text import LINE_SEPARATOR, render_delimited, render_pairs
from wordweave.sources import documents_table, packed_documents, stop_word_list, text_lines_by_folder
from wordweave.sources import word_counts as read_word_counts
from wordweave.sources.delimited import parse_cleaned_lines, parse_stop_words, parse_word_counts

try:
    from wordweave.llm import queries as llm
except ModuleNotFoundError:
    # The operators for training data are a part that can be left out.
    llm = None

SMALL = "/root/testdata/sf0.001"

MIN_COUNT = 4000
MAX_COUNT = 4000
# Words of the benchmark table that occur more often are the stop list from elsewhere.
BENCHMARK_MIN_COUNT = 10
FIRST_LINES = 5000
BLOCK_DOCS = idx.BLOCK_DOCS
FOUR_FIFTHS = Threshold(4, 5, inclusive=True)
HALF = Threshold(1, 2, inclusive=False)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_table(spark, f"{sf_dir}/documents.parquet")


def _unpacked(df: DataFrame, key: str = "key") -> DataFrame:
    """Replace a packed line key by ``doc_id`` and ``line_no``."""
    return df.select(
        F.expr(f"{key} div {LINES_PER_DOCUMENT}").alias("doc_id"),
        F.expr(f"int({key} % {LINES_PER_DOCUMENT})").alias("line_no"),
        *[c for c in df.columns if c != key],
    )


def entry(spark: SparkSession) -> DataFrame:
    """Similar line sets at threshold 4/5; the small corpus takes a lower frequency cap."""
    return similarity_jobs.similar_groups(similarity_jobs.collapsed_line_sets(_documents(spark, SMALL), 400), FOUR_FIFTHS)


def word_count(spark, sf_dir):
    return index_jobs.word_counts(_documents(spark, sf_dir), "alnum")


def word_count_delim(spark, sf_dir):
    return index_jobs.word_counts(_documents(spark, sf_dir), "delim")


def stop_words(spark, sf_dir):
    return index_jobs.stop_words(_documents(spark, sf_dir), MIN_COUNT)


def tokens_without_stop_words(spark, sf_dir):
    return index_jobs.tokens_per_document(_documents(spark, sf_dir), MIN_COUNT)


def inverted_index(spark, sf_dir):
    return index_jobs.inverted_index(_documents(spark, sf_dir), MIN_COUNT)


def inverted_index_rendered(spark, sf_dir):
    return idx.rendered_index(inverted_index(spark, sf_dir))


def inverted_index_boolean(spark, sf_dir):
    return idx.rendered_boolean_index(inverted_index(spark, sf_dir))


def distinct_term_count(spark, sf_dir):
    return terms.distinct_term_count(index_jobs.term_statistics(_documents(spark, sf_dir), MIN_COUNT))


def single_document_terms(spark, sf_dir):
    return terms.single_document_terms(index_jobs.term_statistics(_documents(spark, sf_dir), MIN_COUNT))


def all_lines(spark, sf_dir):
    return lines(_documents(spark, sf_dir))


def line_sets(spark, sf_dir):
    sets = similarity_jobs.line_sets(_documents(spark, sf_dir), MAX_COUNT)
    return _unpacked(ls.rendered_line_sets(sets))


def first_line_sets(spark, sf_dir):
    sets = similarity_jobs.first_line_sets(_documents(spark, sf_dir), FIRST_LINES, MAX_COUNT)
    return _unpacked(ls.rendered_line_sets(sets))


def line_count(spark, sf_dir):
    return ls.line_count(similarity_jobs.non_empty_lines(_documents(spark, sf_dir), MAX_COUNT))


def prefix_postings(spark, sf_dir):
    sets = similarity_jobs.line_sets(_documents(spark, sf_dir), MAX_COUNT)
    return _unpacked(ls.prefix_postings(sets, HALF))


def naive_similarity(spark, sf_dir):
    """All pairs of line sets that share a word, on all lines and without a prefix filter."""
    return similarity_jobs.similar_groups_with_texts(_documents(spark, sf_dir), FOUR_FIFTHS, MAX_COUNT, whole=True)


def similar_groups_with_texts(spark, sf_dir):
    return similarity_jobs.similar_groups_with_texts(_documents(spark, sf_dir), FOUR_FIFTHS, MAX_COUNT)


def prefix_similarity_08(spark, sf_dir):
    return _unpacked(similarity_jobs.line_links(_documents(spark, sf_dir), FOUR_FIFTHS, MAX_COUNT))


def prefix_similarity_05(spark, sf_dir):
    return _unpacked(similarity_jobs.line_links(_documents(spark, sf_dir), HALF, MAX_COUNT))


def similar_groups_08(spark, sf_dir):
    collapsed = similarity_jobs.collapsed_line_sets(_documents(spark, sf_dir), MAX_COUNT)
    return similarity_jobs.similar_groups(collapsed, FOUR_FIFTHS)


def similar_groups_05(spark, sf_dir):
    collapsed = similarity_jobs.collapsed_line_sets(_documents(spark, sf_dir), MAX_COUNT)
    return similarity_jobs.similar_groups(collapsed, HALF)


def line_group_members(spark, sf_dir):
    members = similarity_jobs.collapsed_line_sets(_documents(spark, sf_dir), MAX_COUNT).members
    return _unpacked(members.select("key", "set_id", "n_lines"))


def adjacent_line_scores(spark, sf_dir):
    return similarity_jobs.adjacent_line_scores(_documents(spark, sf_dir), MAX_COUNT)


def naive_comparisons(spark, sf_dir):
    comparisons = ls.naive_comparisons(similarity_jobs.non_empty_lines(_documents(spark, sf_dir), MAX_COUNT))
    # The square of a large number of lines is beyond a bigint.
    return comparisons.withColumn("value", F.col("value").cast("string"))


def prefix_comparisons(spark, sf_dir):
    collapsed = similarity_jobs.collapsed_line_sets(_documents(spark, sf_dir), MAX_COUNT)
    return sim.prefix_comparisons(collapsed.sets, HALF).withColumn("value", F.col("value").cast("bigint"))


def rendered_word_counts(spark, sf_dir):
    return render_delimited(word_count(spark, sf_dir))


def parsed_word_counts(spark, sf_dir):
    return parse_word_counts(rendered_word_counts(spark, sf_dir))


def parsed_stop_words(spark, sf_dir):
    """The stop list written as plain words and read back."""
    return parse_stop_words(render_delimited(stop_words(spark, sf_dir).select("tok")))


def rendered_cleaned_lines(spark, sf_dir):
    sets = similarity_jobs.line_sets(_documents(spark, sf_dir), MAX_COUNT)
    return render_delimited(ls.rendered_line_sets(sets), LINE_SEPARATOR)


def parsed_cleaned_lines(spark, sf_dir):
    return _unpacked(ls.rendered_line_sets(parse_cleaned_lines(rendered_cleaned_lines(spark, sf_dir))))


def _rendered_pairs(spark, sf_dir, in_parentheses):
    groups = similar_groups_with_texts(spark, sf_dir).withColumnsRenamed({"set_lo": "lo", "set_hi": "hi"})
    return render_pairs(groups, in_parentheses)


def rendered_pairs(spark, sf_dir):
    return _rendered_pairs(spark, sf_dir, False)


def rendered_pairs_in_parentheses(spark, sf_dir):
    return _rendered_pairs(spark, sf_dir, True)


def rendered_metrics(spark, sf_dir):
    return render_delimited(distinct_term_count(spark, sf_dir), ": ")


def written_index_metrics(spark, sf_dir):
    """The index written as text, with the metrics that the writing tasks took."""
    return metric_rows(spark, write_index(inverted_index(spark, sf_dir), new_path(spark, "index")))


def written_line_set_metrics(spark, sf_dir):
    """The line sets written as text, with the metrics that the writing tasks took."""
    sets = similarity_jobs.line_sets(_documents(spark, sf_dir), MAX_COUNT)
    return metric_rows(spark, write_line_sets(sets, new_path(spark, "cleaned-lines")))


def text_file_line_sets(spark, sf_dir):
    """Line sets of the documents written to text files and read back."""
    path = new_path(spark, "text-files")
    write_packed_documents(_documents(spark, sf_dir), path)
    read = save(packed_documents(spark, path), "read-lines", "zstd")
    return _unpacked(ls.rendered_line_sets(similarity_jobs.line_sets(read, MAX_COUNT)))


def text_file_index(spark, sf_dir):
    """Index of a folder of text files in which every source is a document of many files."""
    path = new_path(spark, "sources")
    write_text_folders(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, "source")
    return index_jobs.inverted_index(text_lines_by_folder(spark, path, "source"), MIN_COUNT)


def _benchmark_stop_list(spark, sf_dir):
    """The frequent words of the benchmark table, written as a list and read back."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumnRenamed("item_id", "doc_id")
    path = new_path(spark, "stop-list")
    write_delimited(index_jobs.stop_words(items, BENCHMARK_MIN_COUNT), path)
    return stop_word_list(spark, path)


def _index_without_benchmark_words(spark, sf_dir):
    return idx.inverted_index(tokens(_documents(spark, sf_dir), "delim"), _benchmark_stop_list(spark, sf_dir), BLOCK_DOCS)


def _blocked_index(spark, sf_dir):
    return idx.blocked_index(_index_without_benchmark_words(spark, sf_dir))


def inverted_index_foreign_stop_list(spark, sf_dir):
    """The index without the words of a shipped stop list, by way of its blocks."""
    return idx.unblocked_index(_blocked_index(spark, sf_dir))


def inverted_index_blocks(spark, sf_dir):
    joined = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("gaps", "tfs")]
    return _blocked_index(spark, sf_dir).select("tok", "block_no", "n_docs", *joined)


def inverted_index_nested(spark, sf_dir):
    """Posting lists as maps from document to frequency, shown as JSON."""
    return idx.nested_index(inverted_index(spark, sf_dir)).select("tok", F.to_json("postings").alias("postings"))


def replaced_word_counts(spark, sf_dir):
    """Word counts of the documents, replaced by their sum with those of the benchmark items.

    The second job reads the output that it replaces.
    """
    path = new_path(spark, "counts")
    write_delimited(word_count(spark, sf_dir), path)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumnRenamed("item_id", "doc_id")
    both = read_word_counts(spark, path).unionByName(index_jobs.word_counts(items))
    write_delimited(both.groupBy("tok").agg(F.sum("n").alias("n")), path)
    return read_word_counts(spark, path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "word_count": word_count,
        "word_count_delim": word_count_delim,
        "stop_words": stop_words,
        "tokens_without_stop_words": tokens_without_stop_words,
        "inverted_index": inverted_index,
        "inverted_index_rendered": inverted_index_rendered,
        "inverted_index_boolean": inverted_index_boolean,
        "distinct_term_count": distinct_term_count,
        "single_document_terms": single_document_terms,
        "lines": all_lines,
        "line_sets": line_sets,
        "first_line_sets": first_line_sets,
        "line_count": line_count,
        "prefix_postings": prefix_postings,
        "naive_similarity": naive_similarity,
        "similar_groups_with_texts": similar_groups_with_texts,
        "prefix_similarity_08": prefix_similarity_08,
        "prefix_similarity_05": prefix_similarity_05,
        "similar_groups_08": similar_groups_08,
        "similar_groups_05": similar_groups_05,
        "line_group_members": line_group_members,
        "adjacent_line_scores": adjacent_line_scores,
        "naive_comparisons": naive_comparisons,
        "prefix_comparisons": prefix_comparisons,
        "rendered_word_counts": rendered_word_counts,
        "parsed_word_counts": parsed_word_counts,
        "parsed_stop_words": parsed_stop_words,
        "rendered_cleaned_lines": rendered_cleaned_lines,
        "parsed_cleaned_lines": parsed_cleaned_lines,
        "rendered_pairs": rendered_pairs,
        "rendered_pairs_in_parentheses": rendered_pairs_in_parentheses,
        "rendered_metrics": rendered_metrics,
        "written_index_metrics": written_index_metrics,
        "written_line_set_metrics": written_line_set_metrics,
        "text_file_line_sets": text_file_line_sets,
        "text_file_index": text_file_index,
        "inverted_index_foreign_stop_list": inverted_index_foreign_stop_list,
        "inverted_index_blocks": inverted_index_blocks,
        "inverted_index_nested": inverted_index_nested,
        "replaced_word_counts": replaced_word_counts,
        **(llm.queries() if llm else {}),
    }


# SQL building blocks.  They follow the definitions of the results directly: no prefix
# filter and no shared code with the jobs.

_ALNUM = """
alnum AS (
  SELECT doc_id, tok
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS tok FROM documents)
  WHERE tok <> ''
),
alnum_counts AS (SELECT tok, count(*) AS n FROM alnum GROUP BY tok)"""



def _delim_sql(name: str, doc_id: str = "doc_id", table: str = "documents") -> str:
    return rf"""
{name} AS (
  SELECT doc_id, tok
  FROM (
    SELECT doc_id, regexp_replace(raw, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS tok
    FROM (
      SELECT {doc_id} AS doc_id, unnest(regexp_split_to_array(lower(text), '[ .,?!"''()\[\]$*\-_;:|\r\n]')) AS raw
      FROM {table}
    )
  )
  WHERE tok <> ''
),
{name}_counts AS (SELECT tok, count(*) AS n FROM {name} GROUP BY tok)"""


_DELIM = _delim_sql("delim")

_FOREIGN_INDEX = f"""{_DELIM},{_delim_sql("item", "item_id", "benchmark")},
frequencies AS (
  SELECT tok, doc_id, count(*) AS tf FROM delim
  WHERE tok NOT IN (SELECT tok FROM item_counts WHERE n > {BENCHMARK_MIN_COUNT})
  GROUP BY tok, doc_id
)"""

_INDEX = f"""{_DELIM},
frequencies AS (
  SELECT d.tok, d.doc_id, count(*) AS tf
  FROM delim d JOIN delim_counts c ON d.tok = c.tok
  WHERE c.n <= {MIN_COUNT}
  GROUP BY d.tok, d.doc_id
)"""

_LINES = r"""
split_documents AS (
  SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r') AS parts
  FROM documents WHERE length(text) > 0
),
lines AS (
  SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no, unnest(parts) AS line
  FROM split_documents
)"""

_LINE_WORDS = f"""{_ALNUM},{_LINES},
line_words AS (
  SELECT w.doc_id, w.line_no, w.doc_id * {LINES_PER_DOCUMENT} + w.line_no AS k, w.tok, c.n
  FROM (
    SELECT DISTINCT doc_id, line_no, tok
    FROM (
      SELECT doc_id, line_no, unnest(regexp_split_to_array(lower(line), '[^a-z0-9]+')) AS tok FROM lines
    )
  ) w JOIN alnum_counts c ON w.tok = c.tok
  WHERE c.n < {MAX_COUNT}
),
line_texts AS (
  SELECT doc_id, line_no, k, count(*) AS size, string_agg(tok, ' ' ORDER BY n, tok) AS words
  FROM line_words GROUP BY doc_id, line_no, k
)"""

# Pairs of distinct line texts by counting the words they share.
_SET_PAIRS = f"""{_LINE_WORDS},
sets AS (SELECT words, min(k) AS id, min(size) AS size, count(*) AS copies FROM line_texts GROUP BY words),
set_words AS (SELECT s.id, s.size, w.tok FROM sets s JOIN line_words w ON w.k = s.id),
set_pairs AS (
  SELECT a.id AS id_a, b.id AS id_b, count(*) AS inter, min(a.size) + min(b.size) - count(*) AS uni
  FROM set_words a JOIN set_words b ON a.tok = b.tok AND a.id < b.id
  WHERE 2 * a.size >= b.size AND 2 * b.size >= a.size
  GROUP BY a.id, b.id
)"""

_REACHES = {"08": "5 * inter >= 4 * uni", "05": "2 * inter > uni"}


def _links_sql(threshold: str) -> str:
    return f"""WITH {_SET_PAIRS},
matching AS (SELECT id_a, id_b FROM set_pairs WHERE {_REACHES[threshold]}),
sides AS (
  SELECT m.id_a AS id, b.copies AS n FROM matching m JOIN sets b ON b.id = m.id_b
  UNION ALL SELECT m.id_b, a.copies FROM matching m JOIN sets a ON a.id = m.id_a
),
links AS (SELECT id, sum(n) AS n FROM sides GROUP BY id)
SELECT t.doc_id, t.line_no, s.id AS set_id, CAST(s.copies - 1 + coalesce(l.n, 0) AS BIGINT) AS n_links
FROM line_texts t JOIN sets s ON s.words = t.words LEFT JOIN links l ON l.id = s.id"""


def _groups_sql(threshold: str, texts: bool = False) -> str:
    across, within = (", a.words AS text_lo, b.words AS text_hi", ", words, words") if texts else ("", "")
    return f"""WITH {_SET_PAIRS}
SELECT p.id_a AS set_lo, p.id_b AS set_hi, CAST(p.inter AS DOUBLE) / CAST(p.uni AS DOUBLE) AS similarity,
       a.copies AS n_lo, b.copies AS n_hi{across}
FROM set_pairs p JOIN sets a ON a.id = p.id_a JOIN sets b ON b.id = p.id_b
WHERE {_REACHES[threshold]}
UNION ALL
SELECT id, id, CAST(1 AS DOUBLE), copies, copies{within} FROM sets WHERE copies > 1"""


def _rendered_pairs_sql(keys: str) -> str:
    return f"""SELECT {keys} || ' : ' || CAST(CAST(similarity AS FLOAT) AS VARCHAR) || chr(9)
       || '"' || text_lo || '" - "' || text_hi || '"' AS value
FROM ({_groups_sql("08", texts=True)})"""


def oracle_sql() -> dict[str, str]:
    return {
        "word_count": f"WITH {_ALNUM} SELECT tok, n FROM alnum_counts",
        "word_count_delim": f"WITH {_DELIM} SELECT tok, n FROM delim_counts",
        "stop_words": f"WITH {_DELIM} SELECT tok, n FROM delim_counts WHERE n > {MIN_COUNT}",
        "tokens_without_stop_words": f"""WITH {_DELIM}
SELECT d.doc_id, count(*) AS n_tokens
FROM delim d JOIN delim_counts c ON d.tok = c.tok
WHERE c.n <= {MIN_COUNT} GROUP BY d.doc_id""",
        "inverted_index": f"WITH {_INDEX} SELECT tok, doc_id, tf FROM frequencies",
        "inverted_index_rendered": f"""WITH {_INDEX}
SELECT tok, string_agg(CAST(doc_id AS VARCHAR) || '#' || CAST(tf AS VARCHAR), ', ' ORDER BY doc_id) AS postings
FROM frequencies GROUP BY tok""",
        "inverted_index_boolean": f"""WITH {_INDEX}
SELECT tok, string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS docs FROM frequencies GROUP BY tok""",
        "distinct_term_count": f"""WITH {_INDEX}
SELECT 'distinct_terms' AS metric, count(DISTINCT tok) AS value FROM frequencies""",
        "single_document_terms": f"""WITH {_INDEX}
SELECT 'single_document_terms' AS metric, count(*) AS value
FROM (SELECT tok FROM frequencies GROUP BY tok HAVING count(DISTINCT doc_id) = 1)""",
        "lines": f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines",
        "line_sets": f"WITH {_LINE_WORDS} SELECT doc_id, line_no, words FROM line_texts",
        "first_line_sets": f"""WITH {_LINE_WORDS}
SELECT doc_id, line_no, words FROM line_texts ORDER BY doc_id, line_no LIMIT {FIRST_LINES}""",
        "line_count": f"WITH {_LINE_WORDS} SELECT 'lines' AS metric, count(*) AS value FROM line_texts",
        "prefix_postings": f"""WITH {_LINE_WORDS},
ranked AS (
  SELECT doc_id, line_no, tok, row_number() OVER (PARTITION BY k ORDER BY n, tok) AS place,
         count(*) OVER (PARTITION BY k) AS size
  FROM line_words
)
SELECT tok, doc_id, line_no FROM ranked WHERE place <= size - (size + 1) // 2 + 1""",
        "naive_similarity": _groups_sql("08", texts=True),
        "similar_groups_with_texts": _groups_sql("08", texts=True),
        "prefix_similarity_08": _links_sql("08"),
        "prefix_similarity_05": _links_sql("05"),
        "similar_groups_08": _groups_sql("08"),
        "similar_groups_05": _groups_sql("05"),
        "line_group_members": f"""WITH {_LINE_WORDS}
SELECT doc_id, line_no, min(k) OVER (PARTITION BY words) AS set_id, count(*) OVER (PARTITION BY words) AS n_lines
FROM line_texts QUALIFY count(*) OVER (PARTITION BY words) > 1""",
        "adjacent_line_scores": f"""WITH {_LINE_WORDS},
shared AS (
  SELECT a.k AS lo, b.k AS hi, count(*) AS inter
  FROM line_words a JOIN line_words b ON b.doc_id = a.doc_id AND b.line_no = a.line_no + 1 AND a.tok = b.tok GROUP BY a.k, b.k
)
SELECT a.k AS lo, b.k AS hi, CAST(coalesce(s.inter, 0) AS INTEGER) AS inter,
       CAST(a.size + b.size - coalesce(s.inter, 0) AS INTEGER) AS uni
FROM line_texts a JOIN line_texts b ON b.doc_id = a.doc_id AND b.line_no = a.line_no + 1 LEFT JOIN shared s ON s.lo = a.k AND s.hi = b.k""",
        "naive_comparisons": f"""WITH {_LINE_WORDS}
SELECT 'comparisons' AS metric, CAST(count(*) * (count(*) - 1) // 2 AS VARCHAR) AS value FROM line_texts""",
        "prefix_comparisons": f"""WITH {_LINE_WORDS},
ranked AS (
  SELECT tok, row_number() OVER (PARTITION BY k ORDER BY n, tok) AS place, count(*) OVER (PARTITION BY k) AS size
  FROM line_words
),
sizes AS (SELECT tok, count(*) AS c FROM ranked WHERE place <= size - (size + 1) // 2 + 1 GROUP BY tok)
SELECT 'comparisons' AS metric, CAST(sum(c * (c - 1) // 2) AS BIGINT) AS value FROM sizes""",
        "rendered_word_counts": f"WITH {_ALNUM} SELECT tok || ', ' || n AS value FROM alnum_counts",
        "parsed_word_counts": f"WITH {_ALNUM} SELECT tok, n FROM alnum_counts",
        "parsed_stop_words": f"WITH {_DELIM} SELECT tok, CAST(0 AS BIGINT) AS n FROM delim_counts WHERE n > {MIN_COUNT}",
        "rendered_cleaned_lines": f"WITH {_LINE_WORDS} SELECT k || ',' || words AS value FROM line_texts",
        "parsed_cleaned_lines": f"WITH {_LINE_WORDS} SELECT doc_id, line_no, words FROM line_texts",
        "rendered_pairs": _rendered_pairs_sql("set_lo || chr(9) || set_hi"),
        "rendered_pairs_in_parentheses": _rendered_pairs_sql("'(' || set_lo || ', ' || set_hi || ')'"),
        "rendered_metrics": f"""WITH {_INDEX}
SELECT 'distinct_terms: ' || count(DISTINCT tok) AS value FROM frequencies""",
        "written_index_metrics": f"""WITH {_INDEX},
terms AS (SELECT tok, count(*) AS n FROM frequencies GROUP BY tok)
SELECT 'distinct_terms' AS metric, count(*) AS value FROM terms
UNION ALL SELECT 'single_document_terms', count(*) FROM terms WHERE n = 1
UNION ALL SELECT 'postings', CAST(coalesce(sum(n), 0) AS BIGINT) FROM terms""",
        "written_line_set_metrics": f"""WITH {_LINE_WORDS}
SELECT 'lines' AS metric, count(*) AS value FROM line_texts
UNION ALL SELECT 'words', CAST(coalesce(sum(size), 0) AS BIGINT) FROM line_texts""",
        "text_file_line_sets": f"WITH {_LINE_WORDS} SELECT doc_id, line_no, words FROM line_texts",
        "text_file_index": f"""WITH {_delim_sql("delim", "source")}
SELECT d.tok, d.doc_id, count(*) AS tf
FROM delim d JOIN delim_counts c ON d.tok = c.tok WHERE c.n <= {MIN_COUNT} GROUP BY d.tok, d.doc_id""",
        "inverted_index_foreign_stop_list": f"WITH {_FOREIGN_INDEX} SELECT tok, doc_id, tf FROM frequencies",
        "inverted_index_blocks": f"""WITH {_FOREIGN_INDEX},
blocks AS (
  SELECT tok, CAST(floor(doc_id / {BLOCK_DOCS}) AS BIGINT) AS block_no, doc_id, tf FROM frequencies
),
gaps AS (
  SELECT tok, block_no, doc_id, tf,
         doc_id - coalesce(lag(doc_id) OVER (PARTITION BY tok, block_no ORDER BY doc_id), block_no * {BLOCK_DOCS}) AS gap
  FROM blocks
)
SELECT tok, block_no, CAST(count(*) AS INTEGER) AS n_docs,
       string_agg(CAST(gap AS VARCHAR), ',' ORDER BY doc_id) AS gaps, string_agg(CAST(tf AS VARCHAR), ',' ORDER BY doc_id) AS tfs
FROM gaps GROUP BY tok, block_no""",
        "inverted_index_nested": f"""WITH {_INDEX}
SELECT tok, chr(123) || string_agg('"' || doc_id || '":' || tf, ',' ORDER BY doc_id) || chr(125) AS postings
FROM frequencies GROUP BY tok""",
        "replaced_word_counts": f"""WITH {_ALNUM},
item AS (
  SELECT tok FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS tok FROM benchmark) WHERE tok <> ''
)
SELECT tok, count(*) AS n FROM (SELECT tok FROM alnum UNION ALL SELECT tok FROM item) GROUP BY tok""",
        **(llm.oracle_sql() if llm else {}),
    }
