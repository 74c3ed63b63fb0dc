"""The registered queries over the reference operators, and their DuckDB equivalents.

Language rules need code, which the tables lack; their queries put a snippet of code, chosen by
doc_id, before or after the text of every document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import language, notebook, text, tokens
from corpusloom.operators import catalog, decontam, dedup, filters, segments, splits, stats
from corpusloom.session import spread, stored, table
from corpusloom.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs: list[str]) -> str:
    return "[" + ", ".join(map(_lit, xs)) + "]"


def _pick(xs: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, xs)), (F.col("doc_id") % len(xs) + 1).cast("int"))


def _pick_sql(xs: list[str]) -> str:
    return f"{_list(xs)}[CAST(doc_id % {len(xs)} + 1 AS INTEGER)]"


def _solid(t: str) -> str:
    return f"length(regexp_replace({t}, {_lit(text.WHITESPACE)}, '', 'g'))"


def _density(t: str) -> str:
    return f"(CAST(length(regexp_replace({t}, '[^0-9]', '', 'g')) AS DOUBLE) / greatest(1, {_solid(t)}))"


def standard_sql(t: str, density: float = 0.5, size: int = 1_048_575, blank: str = "false") -> str:
    return f"(octet_length(encode({t})) <= {size} AND CASE WHEN {_solid(t)} = 0 THEN {blank} ELSE {_density(t)} <= {density} END)"


def _any(t: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({t}, {_lit(w)})" for w in words) + ")"


@query("corpus_summary", f"SELECT lang, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS size FROM documents WHERE {standard_sql('text', 0.01, 8192)} GROUP BY lang")
def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "documents").where(filters.standard(F.col("text"), 0.01, 8192))
    return kept.groupBy("lang").agg(F.count("*").alias("files"), F.sum(F.octet_length("text")).alias("size"))


@query("std_filter", f"SELECT doc_id, {standard_sql('text', 0.01, 8192)} AS kept FROM documents")
def std_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", filters.standard(F.col("text"), 0.01, 8192).alias("kept"))


@query("density_topk", f"SELECT doc_id, round({_density('text')}, 6) AS density FROM documents ORDER BY {_density('text')} DESC, doc_id LIMIT 100")
def density_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = stats.densest(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id", 100)
    return top.select("doc_id", F.round("measure", 6).alias("density"))


@query("length_extremes", "(SELECT doc_id, length(text) AS measure, true AS longest FROM documents ORDER BY measure DESC, doc_id LIMIT 50) UNION ALL (SELECT doc_id, length(text), false FROM documents ORDER BY length(text), doc_id LIMIT 50)")
def length_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ends = [stats.extremes(docs, F.char_length("text").cast("bigint"), "doc_id", 50, end).select("doc_id", "measure", F.lit(end).alias("longest")) for end in (True, False)]
    return ends[0].unionByName(ends[1])


_KEYWORDS = ["License", "#", "@", "|", "the "]


@query("keyword_reason", f"SELECT doc_id, array_to_string(list_filter({_list(_KEYWORDS)}, lambda k: contains(text, k)), ',') AS found FROM documents")
def keyword_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.found_keywords(F.col("text"), _KEYWORDS), ",").alias("found"))


def _rule(name: str, rule: Callable[..., Column], sql: str, before: list[str] = ["", ""], after: list[str] = [""], **more: list[str]) -> None:
    """Register a query of doc_id and kept over code made from every document; sql is over t and the names in more."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        made = docs.select("doc_id", "n_chars", F.concat(_pick(before), F.col("text"), _pick(after)).alias("t"), *(_pick(v).alias(c) for c, v in more.items()))
        return made.select("doc_id", rule(F.col("t"), *(F.col(c) for c in more)).alias("kept"))

    made = f"SELECT doc_id, n_chars, {_pick_sql(before)} || text || {_pick_sql(after)} AS t" + "".join(f", {_pick_sql(v)} AS {c}" for c, v in more.items()) + " FROM documents"
    query(f"rule_{name}", f"SELECT doc_id, ({sql}) AS kept FROM ({made})")(run)


_WS = text.WHITESPACE
_rule("r", filters.r, f"{standard_sql('t')} AND NOT contains(t, '/* Resource fork') AND NOT regexp_matches(t, {_lit('Requirement' + _WS + '+\\{' + _WS + '+Identifier')}) AND NOT starts_with(t, '<?xml') AND NOT starts_with(t, '{{')".replace("{{", "{"), ["", "/* Resource fork", "Requirement {\n Identifier", "Requirement\u00a0{\u2028Identifier", "<?xml ", " <?xml", "{", "x <- 1\n"])
_rule("maple", filters.maple, f"{standard_sql('t', size=100_000)} AND NOT starts_with(t, '<?xml')", ["", "<?xml", "with(LinearAlgebra);", "9" * 3000])
_rule("standard", filters.standard, standard_sql("t"), ["", "1 2 3 4 5 6 7 8 9 " * 40, "٣" * 900, "\x1c\u00a0\u2028" * 300 + "7" * 500])
_rule("haskell", filters.haskell, f"{standard_sql('t')} AND regexp_matches(t, {_lit('import' + _WS + '+(qualified' + _WS + '+)?(' + '|'.join(filters.HASKELL_PACKAGES) + ')')})", ["", "import Statistics\n", "import  qualified \t Data.Complex\n", "Statistics ", "import NumericXLinearAlgebra\n", "import qualified Data.List\n"])
_rule("c", filters.c, f"{standard_sql('t')} AND {_any('t', filters.C_INCLUDES)}", ["", "#include <fftw3.h>\n", "#include <gsl/gsl_math.h>\n", "#include <stdio.h>\n", "#include  <blas.h>\n", "#include <petsc.h>\n", "#include <fftw3.h>#include <rfftw.h>"])
_rule("c_fused", lambda t: filters.c(t, fused=True), f"{standard_sql('t')} AND {_any('t', filters.C_INCLUDES_FUSED)}", ["", "#include <fftw3.h>\n", "#include <fftw3.h>#include <rfftw.h>", "#include <gsl/gsl_math.h>\n"])
_rule("cpp", filters.cpp, f"{standard_sql('t', 0.1)} AND {_any('t', filters.CPP_INCLUDES)}", ["", "#include <Eigen/Dense>\n", "#include <boost/math.hpp>\n", "#include <vector>\n", "#include <mtl/mtl.h>\n" + "12345 " * 60])
_lines = "(length(t) - length(replace(t, chr(10), '')) + 1)"
_tests = "CAST(floor((length(t) - length(replace(t, '@test', ''))) / 5.0) AS BIGINT)"
_julia = f"t <> '' AND NOT (substr(t, 1, 1) IN ('%', '{{', '[')) AND CASE WHEN CAST(size AS BIGINT) >= 100000 THEN {_tests} > 0 AND CAST({_tests} AS DOUBLE) / {_lines} >= 0.1 AND {_density('t')} <= 0.5 ELSE true END".replace("{{", "{")
_JULIA = ["", "% data\n", "{", "[1]", "@test sin(1)\n" * 3, "using Test\n", " πsinπ ", "x sin y\n"]
_SIZES = ["10", "99999", "100000", "5000000", "100000"]
_rule("julia", lambda t, size: filters.julia(t, size.cast("bigint")), _julia, _JULIA, size=_SIZES)
_WORD = r"[\p{L}\p{M}\p{Nd}\p{Pc}\x{200c}\x{200d}\x{24b6}-\x{24e9}\p{Nl}]"
_NOT_WORD = "[^" + _WORD[1:]
_rule("julia_strict", lambda t, size: filters.julia_strict(t, size.cast("bigint")), f"{_julia} AND regexp_matches(t, {_lit(_NOT_WORD + '(' + '|'.join(filters.JULIA_WORDS) + ')' + _NOT_WORD)})", _JULIA, size=_SIZES)
_rule("tex", lambda t, ext, path, lang: filters.tex(t, ext, path, lang == "en"), f"ext = 'tex' AND {standard_sql('t', size=10_000_000)} AND NOT contains(path, 'latex/') AND NOT contains(t, 'gnuplot') AND {_any('t', filters.TEX_SECTIONS)} AND lang = 'en'", ["", "\\section{A}\n", "\\paragraph*{A}\n", "\\chapter*{gnuplot}\n", "\\subsubsection*{B}\n"], ext=["tex", "sty", "tex"], path=["a/b.tex", "latex/a.tex", "x/latex/y.tex", "c.tex"], lang=["en", "en", "de"])
_rule("notebook", filters.notebook, _any("lower(t)", filters.NOTEBOOK_WORDS), ["", "IMPORT SYMPY\n", "\\Begin{Equation}", "\\begin{align*}", "from sympy import *"])
_rule("coq", filters.coq, f"{standard_sql('t', blank='true')} AND {_any('t', filters.COQ_WORDS)} AND NOT {_any('t', filters.VERILOG_WORDS)} AND NOT contains(t, 'This file was automatically generated')", ["", "Theorem a : b.\n", "Proof. Qed. wire", "Fixpoint\nThis file was automatically generated", "endmodule", "Definition d := 1.\n"])
_rule("lean", filters.lean, f"{standard_sql('t', blank='true')} AND {_any('t', filters.LEAN_WORDS)} AND NOT (repo IN ('ProofNet', 'miniF2F')) AND NOT contains(path, '_target/deps/')", ["", "theorem a : b\n", "lemma\n", "example : c\n"], repo=["mathlib", "miniF2F", "miniF2F-extra", "ProofNet", "x"], path=["src/a.lean", "_target/deps/m/a.lean", "b.lean"])
_rule("isabelle", filters.isabelle, f"{standard_sql('t', blank='true')} AND {_any('t', filters.ISABELLE_WORDS)} AND NOT starts_with(repo, 'mirror-afp-2')", ["", "theorem x: y\n", "lemma z: w\n"], repo=["a", "mirror-afp-2021", "mirror-afp-devel", "x-mirror-afp-2021"])
_rule("matlab", filters.matlab, f"{standard_sql('t', blank='true')} AND NOT {_any('t', [*filters.OBJECTIVE_C_WORDS, '#include'])} AND NOT regexp_matches(t, ' main\\([^\\n]*\\{{\\n?\\z')".replace("{{", "{"), ["", "#import <a.h>\n", "function y = f(x)\n", "@interface A\n", "#include <a>\n"], ["", " int main(void){", " int main(void){\n", " int main(void){\r", " main(){\nx"])
_rule("generated", filters.generated, "contains(t, 'generated') OR starts_with(t, '.')", ["", ".hidden", "my-generated-code", "a."])

_PYTHON = ["", "import numpy\nfrom scipy import x\n", "  {", "import sagemaker\n", "\u00a0\n{\"cells\": []", "from jax import numpy\nimport jax\n", "1 " * 20000]
_python_sql = f"CASE WHEN NOT {standard_sql('t')} THEN 'standard' WHEN regexp_extract(t, {_lit('^' + _WS + '*([^' + chr(92) + 'x00])')}, 1) = '{{' THEN 'notebook' WHEN len(found) = 0 THEN 'not found' ELSE array_to_string(found, ',') END".replace("{{", "{")


@query("rule_python", f"SELECT doc_id, {_python_sql} AS reason FROM (SELECT doc_id, t, list_filter({_list(filters.python_keywords())}, lambda k: contains(t, k)) AS found FROM (SELECT doc_id, {_pick_sql(_PYTHON)} || text AS t FROM documents))")
def rule_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", filters.python_reason(F.concat(_pick(_PYTHON), F.col("text"))).alias("reason"))


def _dedup(size: int) -> None:
    sql = f"""
    WITH c AS (
      SELECT doc_id, place, sha256(substr(text, CAST(place * {size} + 1 AS BIGINT), {size})) AS h
      FROM (SELECT doc_id, text, unnest(range(0, greatest(1, length(text) // {size}))) AS place FROM documents WHERE length(text) > 0)),
    r AS (SELECT doc_id, row_number() OVER (PARTITION BY h ORDER BY doc_id, place) AS n FROM c)
    SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r WHERE n > 1)"""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        late = docs.select("doc_id", "text")
        return docs.select("doc_id", "lang", "source").join(dedup.chunk_dedup(late, size=size).select("doc_id"), "doc_id", "left_semi")

    query(f"chunk_dedup_{size}", sql.replace(f"length(text) // {size}", f"CAST(floor(length(text) / {size}.0) AS BIGINT)"))(run)


for _size in (2048, 512, 128):
    _dedup(_size)


@query("decontam_antijoin", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text <> '' AND contains(d.text, b.text))")
def decontam_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return decontam.without_containing(docs, table(spark, sf_dir, "benchmark")).select("doc_id")


_removed = """
SELECT doc_id, CASE WHEN at = 0 THEN text WHEN stop = 0 THEN substr(text, 1, at - 1) ELSE substr(text, 1, at - 1) || substr(text, at + stop - 1) END AS text, at > 0 AS removed
FROM (SELECT doc_id, text, at, CASE WHEN at > 0 THEN strpos(substr(text, at), chr(10)) ELSE 0 END AS stop FROM (SELECT doc_id, text, strpos(text, 'Licensed') AS at FROM documents))
"""


@query("remove_until", _removed.replace(" at ", " pos ").replace("(text, at)", "(text, pos)").replace(" at,", " pos,").replace("at -", "pos -").replace("at +", "pos +"))
def remove_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, had = text.without_part(F.col("text"), F.lit("Licensed"), "\n")
    return table(spark, sf_dir, "documents").select("doc_id", cut.alias("text"), had.alias("removed"))


@query("segments", "SELECT conv_id, segment, count(*) - 1 AS length FROM (SELECT conv_id, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS segment FROM conversations) GROUP BY conv_id, segment")
def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segments.numbered_segments(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", F.col("role") == "user")
    return rows.groupBy("conv_id", "segment").agg((F.count("*") - 1).alias("length"))


_proofs = """
WITH s AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN '' ELSE role END AS state, CASE WHEN role = 'user' THEN 'lemma ' || text ELSE text END AS step FROM conversations),
g AS (SELECT *, sum(CASE WHEN state = '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS seg FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, seg ORDER BY turn) AS k FROM g)
SELECT conv_id, string_agg(CASE WHEN k = 1 THEN '[STATEMENT]' || chr(10) || step ELSE chr(10) || '[PROOF STATE]' || chr(10) || state || chr(10) || '[PROOF STEP]' || chr(10) || step END, '' ORDER BY turn) AS proof, count(*) - 1 AS length
FROM r GROUP BY conv_id, seg HAVING starts_with(first(step ORDER BY turn), 'lemma ') OR starts_with(first(step ORDER BY turn), 'theorem ')
"""


@query("proof_render", _proofs)
def proof_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as proof traces; turns are numbered by segment first, so no trace is gathered whole."""
    user = F.col("role") == "user"
    pair = F.array(F.when(user, "").otherwise(F.col("role")), F.when(user, F.concat(F.lit("lemma "), F.col("text"))).otherwise(F.col("text")))
    rows = segments.numbered_segments(table(spark, sf_dir, "conversations"), "conv_id", "turn", user)
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("turn", pair.alias("pair")))), lambda x: x["pair"])
    traces = rows.groupBy(F.col("conv_id").alias("file"), "segment").agg(pairs.alias("translations")).drop("segment")
    return segments.proofs(traces).select(F.col("file").alias("conv_id"), "proof", F.col("length").cast("bigint").alias("length"))


def _hash(seed: int) -> str:
    return f"sha256('{seed}:' || CAST(doc_id AS VARCHAR))"


@query("hash_split", f"WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_hash(74)} DESC, CAST(doc_id AS VARCHAR) DESC) AS n, greatest(CAST(floor(0.005 * count(*) OVER ()) AS BIGINT), 1) AS t FROM documents) SELECT doc_id, CASE WHEN n <= t THEN 'test' WHEN n <= 2 * t THEN 'validation' ELSE 'train' END AS split FROM r")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.hash_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("bernoulli_split", f"SELECT doc_id, CASE WHEN u < 0.005 THEN 'validation' WHEN u < 0.01 THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, CAST(('0x' || substr({_hash(7)}, 1, 12)) AS BIGINT) / 281474976710656.0 AS u FROM documents)")
def bernoulli_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.bernoulli_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("positional_split", """
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents),
b AS (SELECT *, CAST(floor(n * 99 / 100.0) AS BIGINT) AS train FROM r)
SELECT doc_id, source, CASE WHEN k <= train THEN 'train' WHEN k <= train + CAST(floor((n - train) / 2.0) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM b""")
def positional_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.positional_split(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")


@query("lang_stats", "SELECT coalesce(lang, 'CUMULATIVE') AS lang, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS size, CAST(sum(n_chars) AS BIGINT) AS num_tokens FROM documents GROUP BY ROLLUP (lang)")
def lang_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_cumulative(table(spark, sf_dir, "documents"), "lang", F.octet_length("text"), F.col("n_chars"))


@query("lang_order", "SELECT lang, round(sum(n_chars) / 1e9, 9) AS tokens_bn, round(sum(octet_length(encode(text))) / 1e9, 9) AS size_gb FROM documents GROUP BY lang ORDER BY sum(n_chars) DESC")
def lang_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.corpus_stats(table(spark, sf_dir, "documents"), "lang", size=F.octet_length("text"), tokens=F.col("n_chars"))
    return rows.orderBy(F.desc("num_tokens")).select("lang", F.round(F.col("num_tokens") / 1e9, 9).alias("tokens_bn"), F.round(F.col("size") / 1e9, 9).alias("size_gb"))


@query("source_index", "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def source_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.index_of(table(spark, sf_dir, "documents"), "source")


@query("token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = tokens.counters(num_tokens=tokens.ranks_of(tokens.public_path("byte_bpe_50k.tiktoken")), llama_tokens=tokens.pieces_of(tokens.public_path("piece_bpe_32k.model")))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", count("text").alias("n")).select("doc_id", "n.num_tokens", "n.llama_tokens")


@query("token_total")
def token_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, sf_dir).agg(F.sum("num_tokens").alias("num_tokens"), F.sum("llama_tokens").alias("llama_tokens"))


_MARKS = ["", '![a](b.png "c") ', "![a](b.png)", "<img src=x>", "<video>\nx</video>", "<iframe a></iframe>", "<SCRIPT>y</SCRIPT>"]


def _stripped_sql(t: str) -> str:
    return f"""regexp_replace(regexp_replace(regexp_replace({t}, '!\\[[^\\]]*\\]\\(.*?(?:".*")?\\)', '', 'g'), '<img[^>]*>', '', 'g'), '(?s)<video.*?</video>|<script.*?</script>|<iframe.*?</iframe>', '', 'g')"""


@query("html_strip", f"SELECT page_id, {_stripped_sql('t')} AS html FROM (SELECT page_id, {_pick_sql(_MARKS).replace('doc_id', 'page_id')} || html AS t FROM pages)")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "pages").withColumn("doc_id", F.col("page_id")).withColumn("t", F.concat(_pick(_MARKS), F.col("html")))
    return marked.select("page_id", notebook.stripped(F.col("t")).alias("html"))


@query("notebook_markdown", f"""SELECT doc_id, doc_id % 3 <> 0 AS converted, CASE WHEN doc_id % 3 = 0 THEN text ELSE {_stripped_sql("text || chr(10)")} END AS content FROM documents""")
def notebook_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one-cell notebooks, every third without being one, converted."""
    cell = F.to_json(F.struct(F.array(F.struct(F.lit("markdown").alias("cell_type"), F.col("text").alias("source"))).alias("cells"), F.struct(F.lit("en").alias("lang")).alias("metadata")))
    books = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(cell).alias("content"))
    return notebook.convert_notebooks(books).select("doc_id", "converted", "content")


_fenced = "'```' || {} || chr(10) || text || chr(10) || '```'"
_indented = "'    ' || replace(regexp_replace(text, '\\n+$', ''), chr(10), chr(10) || '    ')"


@query("notebook_outputs", f"""
WITH p AS (SELECT doc_id, text, doc_id % 6 AS kind FROM documents),
q AS (SELECT doc_id, kind, text, CASE kind
  WHEN 0 THEN {_fenced.format("'python'")} || chr(10) || chr(10) || {_indented}
  WHEN 1 THEN {_fenced.format("''")}
  WHEN 2 THEN {_fenced.format("''")}
  WHEN 3 THEN '## ' || text || chr(10) || chr(10) || {_fenced.format("''")} || chr(10) || chr(10) || {_indented}
  ELSE {_fenced.format("'julia'")} || chr(10) || chr(10) || text END || chr(10) AS page FROM p)
SELECT doc_id, kind <> 4 AS converted, CASE WHEN kind = 4 THEN '{{"cells": ' || text ELSE {_stripped_sql("page")} END AS content FROM q""")
def notebook_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as notebooks with code and outputs: a stream, an image, an error, version 3, broken JSON, Markdown."""
    t, typed = F.col("text"), lambda kind, *more: F.struct(F.lit(kind).alias("output_type"), *more)
    stream = typed("stream", F.array(t, F.lit("\n")).alias("text"))
    image = typed("display_data", F.struct(F.lit("aGk=").alias("image/png"), F.lit("<Figure>").alias("text/plain")).alias("data"))
    error = typed("error", F.lit("E").alias("ename"), F.array(F.lit("line")).alias("traceback"))
    shown = typed("execute_result", F.struct(F.lit("less").alias("text/plain"), t.alias("text/markdown")).alias("data"))

    def code(outputs: Column, source: str = "source") -> Column:
        return F.struct(F.lit("code").alias("cell_type"), F.array(t).alias(source), outputs.alias("outputs"))

    def book(cells: Column, meta: Column | None = None) -> Column:
        return F.to_json(F.struct(cells.alias("cells"), (F.struct(F.lit(4).alias("x")) if meta is None else meta).alias("metadata")))

    heading = F.to_json(F.struct(F.lit("heading").alias("cell_type"), F.lit(2).alias("level"), t.alias("source")))
    old = F.concat(F.lit('{"worksheets": [{"cells": ['), heading, F.lit(", "), F.to_json(code(F.array(typed("pyout", t.alias("text"))), "input")), F.lit("]}]}"))
    kinds = [
        book(F.array(code(F.array(stream))), F.struct(F.struct(F.lit("p").alias("name")).alias("kernelspec"))),
        book(F.array(code(F.array(image)))),
        book(F.array(code(F.array(error)))),
        old,
        F.concat(F.lit('{"cells": '), t),
        book(F.array(code(F.array(shown))), F.struct(F.struct(F.lit("julia").alias("name")).alias("language_info"))),
    ]
    content = F.lit(None).cast("string")
    for k, made in enumerate(kinds):
        content = F.when(F.col("doc_id") % len(kinds) == k, made).otherwise(content)
    return notebook.convert_notebooks(table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))).select("doc_id", "converted", "content")


def _dated(df: DataFrame) -> DataFrame:
    """Dates as text, which every engine writes alike."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})


@query("week_intervals", """
WITH b AS (SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events)
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS "left", CAST(least(CAST(d AS DATE) + 7, last) AS VARCHAR) AS "right"
FROM (SELECT unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 7 DAY)) AS d, last FROM b)""")
def week_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weeks from the first event to the last."""
    day = F.to_date("ts")
    first, last = table(spark, sf_dir, "events").agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
    return _dated(catalog.week_intervals(spark, first, last))


@query("events_by_week", """
WITH w AS (SELECT CAST(d AS DATE) AS l, least(CAST(d AS DATE) + 7, DATE '2024-01-31') AS r FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 7 DAY)) AS d))
SELECT CAST(l AS VARCHAR) AS "left", CAST(r AS VARCHAR) AS "right", event_type, count(*) AS n FROM events JOIN w ON CAST(ts AS DATE) BETWEEN l AND r GROUP BY l, r, event_type""")
def events_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.in_weeks(table(spark, sf_dir, "events").select("ts", "event_type"), "ts", "2024-01-01", "2024-01-31")
    return _dated(rows.groupBy("left", "right", "event_type").agg(F.count("*").alias("n")))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as repositories: the customer is the author, the price the stars."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("author"), F.col("o_orderkey").cast("string").alias("repo"), F.col("o_orderstatus").alias("lang"),
        F.floor("o_totalprice").cast("bigint").alias("stars"), F.to_date("o_orderdate").alias("created"),
    )


_catalog_sql = "SELECT CAST(o_custkey AS VARCHAR) AS author, CAST(o_orderkey AS VARCHAR) AS repo, o_orderstatus AS lang, CAST(floor(o_totalprice) AS BIGINT) AS stars, CAST(o_orderdate AS DATE) AS created FROM orders"


@query("top_k_repos", f"SELECT author, repo, lang, stars, CAST(created AS VARCHAR) AS created FROM ({_catalog_sql}) WHERE lang = 'O' ORDER BY stars DESC, author, repo LIMIT 1000")
def top_k_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(catalog.top_repos(_catalog(spark, sf_dir), "O", 1000))


@query("repos_by_week", f"""
WITH w AS (SELECT CAST(d AS DATE) AS l, least(CAST(d AS DATE) + 7, DATE '2001-08-01') AS r FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 7 DAY)) AS d))
SELECT author, repo, lang, stars, CAST(created AS VARCHAR) AS created, CAST(l AS VARCHAR) AS "left", CAST(r AS VARCHAR) AS "right" FROM ({_catalog_sql}) JOIN w ON created BETWEEN l AND r WHERE lang = 'F' ORDER BY l, stars DESC, author, repo LIMIT 1000""")
def repos_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(catalog.repos_by_week(_catalog(spark, sf_dir), "F", "1995-01-01", "2001-08-01", 1000))


@query("asof_latest", "SELECT o_custkey, max(o_orderdate) AS o_orderdate, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' GROUP BY o_custkey")
def asof_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.latest_by(table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey", "o_orderdate", "o_orderkey", "1998-01-01")


@query("sha_asof", "SELECT CAST(c_custkey AS VARCHAR) AS author, coalesce(arg_max(CAST(o_orderkey AS VARCHAR), (o_orderdate, CAST(o_orderkey AS VARCHAR))), 'master') AS sha FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderdate <= TIMESTAMP '1996-01-01' GROUP BY c_custkey")
def sha_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    repos = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("author"), F.lit("r").alias("repo"))
    commits = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("author"), F.lit("r").alias("repo"), F.col("o_orderkey").cast("string").alias("sha"), F.col("o_orderdate").alias("committed"))
    return catalog.latest_as_of(repos, commits, "1996-01-01").select("author", "sha")


@query("english_only", "SELECT doc_id FROM documents WHERE lang = 'en'")
def english_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.col("lang") == "en").select("doc_id")


@query("language_of_text", """
WITH g AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(text) - 1), lambda i: substr(text, i, 3))) AS gram FROM documents),
c AS (SELECT lang, gram, count(*) AS n FROM g WHERE doc_id % 2 = 0 AND lang IS NOT NULL GROUP BY ALL),
t AS (SELECT lang, sum(n) AS total, (SELECT count(DISTINCT gram) FROM c) AS grams FROM c GROUP BY lang),
d AS (SELECT doc_id, gram, count(*) AS m FROM g GROUP BY ALL),
s AS (SELECT doc_id, t.lang AS lang, sum(m * CAST(floor(1000 * ln(CAST(coalesce(n, 0) + 1 AS DOUBLE) / (total + grams))) AS BIGINT)) AS score
  FROM d CROSS JOIN t LEFT JOIN c ON c.gram = d.gram AND c.lang = t.lang GROUP BY doc_id, t.lang),
b AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS r FROM s)
SELECT doc_id, b.lang AS language FROM documents LEFT JOIN b USING (doc_id) WHERE r = 1 OR r IS NULL""")
def language_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language from its text, by a model of the labelled documents of even number."""
    docs = spread(table(spark, sf_dir, "documents"))
    model = language.LanguageModel(stored(language.train(docs.where("doc_id % 2 = 0")), "language-model").toArrow())
    return docs.select("doc_id", language.language_of(F.col("text"), model, spark).alias("language"))


@query("as_documents", "SELECT text, doc_id, lang FROM documents")
def as_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = sinks.as_documents(table(spark, sf_dir, "documents"), "text")
    return nested.select("text", "meta.doc_id", "meta.lang")


_FILES = ["thys_A", "2022-12-06_thys_Abc.thy_output.json", "x2022-12-06_thys_A.thy_output.json.thy_output.json"]


@query("theory_names", f"SELECT doc_id, CASE WHEN regexp_matches(f, '2022-12-06_thys_(.*?)\\.thy_output\\.json') THEN regexp_extract(f, '2022-12-06_thys_(.*?)\\.thy_output\\.json', 1) END AS theory, replace(regexp_replace(f, '\\.json$', ''), '/', '.') AS module FROM (SELECT doc_id, {_pick_sql(_FILES)} || '/' || source AS f FROM documents)")
def theory_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = F.concat(_pick(_FILES), F.lit("/"), F.col("source"))
    return table(spark, sf_dir, "documents").select("doc_id", text.theory_of(file).alias("theory"), text.module_name(file, ".json").alias("module"))


#: Names as held-out theorems have them; the last name of a file counts.
_THEOREMS = [("src/a", "The.old.one", 0), ("src/a", "The.the.of", 1), ("src/b", "a.In", 2), ("lib", "Short", 3), ("src", "Et.la.le", 4)]
_PATHS = ["src/a/x.lean", "src/b/y.lean", "lib/z.lean", "other.lean"]
_STARTS = ["lemma the.of x\n\n", "theorem of y := z ", "theorem In \n\nlemma In ", "lemma le :\n\nlemma la.le :\n\n", ""]


@query("lean_removal", f"""
WITH d AS (SELECT doc_id, {_pick_sql(_STARTS)} || text AS t0, {_pick_sql(_PATHS)} AS path FROM documents),
s1 AS (SELECT doc_id, path, t0, CASE WHEN contains(path, 'src/a') THEN ['theorem of ', 'theorem the.of '] ELSE [] END AS g1, CASE WHEN contains(path, 'src/a') THEN ['lemma of ', 'lemma the.of '] ELSE [] END AS g2,
  CASE WHEN contains(path, 'src/b') THEN ['theorem In '] ELSE [] END AS g3, CASE WHEN contains(path, 'src/b') THEN ['lemma In '] ELSE [] END AS g4,
  CASE WHEN contains(path, 'src') THEN ['theorem le ', 'theorem la.le '] ELSE [] END AS g5, CASE WHEN contains(path, 'src') THEN ['lemma le ', 'lemma la.le '] ELSE [] END AS g6 FROM d),
""" + ",\n".join(
    f"""n{k} AS (SELECT *, coalesce(list_filter(g{k}, lambda x: contains(t{k - 1}, x))[1], '') AS x{k} FROM {'s1' if k == 1 else f'u{k - 1}'}),
u{k} AS (SELECT *, CASE WHEN x{k} = '' THEN t{k - 1} ELSE substr(t{k - 1}, 1, strpos(t{k - 1}, x{k}) - 1) || CASE WHEN contains(substr(t{k - 1}, strpos(t{k - 1}, x{k})), chr(10) || chr(10)) THEN substr(t{k - 1}, strpos(t{k - 1}, x{k}) - 1 + strpos(substr(t{k - 1}, strpos(t{k - 1}, x{k})), chr(10) || chr(10))) ELSE '' END END AS t{k} FROM n{k})"""
    for k in range(1, 7)
) + " SELECT doc_id, t6 AS text, (" + " OR ".join(f"x{k} <> ''" for k in range(1, 7)) + ") AS was_transformed FROM u6")
def lean_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(_pick(_STARTS), F.col("text")).alias("text"), _pick(_PATHS).alias("path"))
    needles = decontam.theorem_needles(decontam.one_per_file(spark.createDataFrame(_THEOREMS, "file string, name string, rank bigint")))
    return decontam.without_theorems(docs, needles, "doc_id", "text", "path").select("doc_id", "text", "was_transformed")


_NAMES = ["theorem b:", "lemma a:"]
_STATED = ["lemma a: x\n\nrest ", "theorem b: lemma a: y ", "theorem b: \n\n lemma a:\n\n", ""]


def _cut_sql(t: str, name: str) -> str:
    """SQL for t less the passage from name on; both are SQL expressions."""
    tail = f"substr({t}, strpos({t}, {name}))"
    return f"CASE WHEN contains({t}, {name}) THEN substr({t}, 1, strpos({t}, {name}) - 1) || CASE WHEN contains({tail}, chr(10) || chr(10)) THEN substr({tail}, strpos({tail}, chr(10) || chr(10))) ELSE '' END ELSE {t} END"


_BEGINNING = r"^\S+ \S+ \S+"


@query("isabelle_removal", rf"""
WITH names AS (SELECT DISTINCT name FROM (SELECT regexp_extract(text, '{_BEGINNING}') AS name FROM benchmark UNION ALL SELECT unnest({_list(_NAMES)})) WHERE name <> ''),
d AS (SELECT doc_id, {_pick_sql(_STATED)} || text AS t FROM documents),
r AS (SELECT doc_id, t, list_reduce(list_prepend(t, (SELECT list(name ORDER BY name) FROM names)), lambda a, n: {_cut_sql('a', 'n')}) AS text FROM d)
SELECT doc_id, text, text <> t AS was_transformed FROM r""")
def isabelle_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages from the beginnings of benchmark texts on, and from two fixed names, are removed."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", F.concat(_pick(_STATED), F.col("text")).alias("text")))
    fixed = spark.createDataFrame([(n,) for n in _NAMES], "name string")
    names = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", _BEGINNING, 0).alias("name")).union(fixed)
    return decontam.without_statements(docs, names, "text")


@query("decontam_short", r"""
WITH held AS (SELECT DISTINCT regexp_extract(text, '^\S+ \S+') AS s FROM benchmark)
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM held WHERE s <> '' AND contains(d.text, s))""")
def decontam_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the first two words of any benchmark text."""
    held = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", r"^\S+ \S+", 0).alias("s"))
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return decontam.without_containing(docs, held, needle="s").select("doc_id")


@query("statement_names", "SELECT DISTINCT split_part(text, '.', 1) AS x, split_part(split_part(text, '.', 1), ':', 1) || ':' AS name FROM benchmark")
def statement_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select(F.split_part("text", F.lit("."), F.lit(1)).alias("x")).distinct()
    return rows.join(decontam.statement_names(rows, "x"), F.concat(F.split_part("x", F.lit(":"), F.lit(1)), F.lit(":")) == F.col("name"))


@query("transformed_total", "SELECT CAST(sum(CASE WHEN contains(text, 'Licensed') THEN 1 ELSE 0 END) AS BIGINT) AS transformed FROM documents")
def transformed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, had = text.without_part(F.col("text"), F.lit("Licensed"), "\n")
    return stats.transformed_count(table(spark, sf_dir, "documents").select(had.alias("was_transformed")))


@query("held_out_json", "SELECT text AS statement FROM benchmark WHERE text <> ''")
def held_out_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as the entries of a held-out JSON list, parsed."""
    listed = table(spark, sf_dir, "benchmark").select(F.to_json(F.array(F.array(F.lit("id"), F.col("text")), F.array(F.lit("alone")))).alias("value"))
    rows = listed.select(F.explode(F.from_json("value", readers.HELD_OUT_STATEMENTS)).alias("x")).where(F.size("x") > 1)
    return rows.select(F.get("x", F.lit(1)).alias("statement")).where("statement <> ''")
