"""Language rules as predicates, and the registry that maps a language to its rule.

Rules read content (or text), and some of them size, ext, path or repo. A blank text is
rejected wherever density is asked for. Bytes are compared before density.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITESPACE, contains_any, count_of, dense, is_blank

MAX_BYTES, MAX_DENSITY = 1_048_575, 0.5

# Keywords that the rules look for.
HASKELL_PACKAGES = ["Numeric.LinearAlgebra", "Numeric.SpecFunctions", "Numeric.Vector", "Statistics", "Data.Complex"]
PYTHON_PACKAGES = ["numpy", "scipy", "sympy", "sage", "numba", "numexpr", "theano", "statsmodels", "networkx", "mpmath", "pymc3", "astropy", "cupy", "pycuda", "cvxpy", "pyomo", "jax"]
C_INCLUDES = ["#include <fftw.h>", "#include <fftw3.h>", "#include <rfftw.h>", "#include <gsl", "#include <cblas.h>", "#include <blas.h>", "#include <lapacke.h>", "#include <nlopt.h>", "#include <petsc.h>"]
C_INCLUDES_FUSED = ["#include <fftw.h>", "#include <fftw3.h>#include <rfftw.h>", "#include <gsl", "#include <cblas.h>", "#include <blas.h>", "#include <lapacke.h>", "#include <nlopt.h>", "#include <petsc.h>"]
CPP_INCLUDES = ["#include <adept_arrays.h>", "#include <adept.h>", "#include <alglib", "#include <boost", "#include <armadillo", "#include <blitz", "#include <Eigen", "#include <deal.II", "#include <dlib", "#include <NTL", "#include <mtl"]
JULIA_WORDS = ["LinearAlgebra", "DifferentialEquations", "Symbolics", "Distributions", "DataFrames", "DynamicalSystems", "Turing", "Gen", "JuMP", "sqrt", "abs", "zeros", "ones", "sin", "cos", "tan", "log", "exp", "integrate", "likelihood", "Matrix", "π", "pi", "rand", "grad"]
TEX_SECTIONS = ["\\chapter{", "\\chapter*{", "\\section{", "\\section*{", "\\subsection{", "\\subsection*{", "\\subsubsection{", "\\subsubsection*{", "\\paragraph{", "\\subparagraph{"]
NOTEBOOK_WORDS = ["\\begin{equation}", "\\begin{align}", "import sympy", "from sympy"]
COQ_WORDS, VERILOG_WORDS = ["Theorem", "Proof", "Qed", "Inductive", "Definition", "Fixpoint"], ["pragma", "endmodule", "posedge", "negedge", "wire"]
LEAN_WORDS, LEAN_HELD_OUT = ["theorem ", "lemma ", "example "], ["ProofNet", "miniF2F"]
ISABELLE_WORDS = ["theorem ", "lemma "]
OBJECTIVE_C_WORDS = ["#import", "@interface", "@implementation", "@property"]
STACK_LANGUAGES = ["r", "maple", "gap", "lean", "isabelle", "idris", "agda", "haskell", "python", "jupyter-notebook", "julia", "c", "cpp", "fortran", "tex"]
GITHUB_EXTENSIONS = {"coq": ".v", "isabelle": ".thy", "lean": ".lean", "matlab": ".m"}


def standard(text: Column, max_density: float = MAX_DENSITY, max_bytes: int = MAX_BYTES, blank: bool = False) -> Column:
    """At most max_bytes of UTF-8 and max_density; blank: what a text without characters gets."""
    fits = F.octet_length(text) <= max_bytes
    return fits & dense(text, max_density) if blank else fits & ~is_blank(text) & dense(text, max_density)


def r(text: Column) -> Column:
    return standard(text) & ~F.contains(text, F.lit("/* Resource fork")) & ~text.rlike(f"Requirement{WHITESPACE}+\\{{{WHITESPACE}+Identifier") & ~F.startswith(text, F.lit("<?xml")) & ~F.startswith(text, F.lit("{"))


def maple(text: Column) -> Column:
    return standard(text, max_bytes=100_000) & ~F.startswith(text, F.lit("<?xml"))


def haskell(text: Column) -> Column:
    """Imports one of the packages; a dot in a package's name stands for any character."""
    return standard(text) & text.rlike(f"(?d)import{WHITESPACE}+(qualified{WHITESPACE}+)?({'|'.join(HASKELL_PACKAGES)})")


def python_keywords() -> list[str]:
    return [f"{how} {p}" for p in PYTHON_PACKAGES for how in ("import", "from")]


def python_reason(text: Column) -> Column:
    """Why a file is kept or not: standard, notebook, not found, or the keywords found."""
    first = F.regexp_extract(text, f"^{WHITESPACE}*([^\\x00])", 1)
    found = F.concat_ws(",", *(F.when(F.contains(text, F.lit(k)), k) for k in python_keywords()))
    return F.when(~standard(text), "standard").when(first == "{", "notebook").otherwise(F.regexp_replace(found, "^$", "not found"))


def python(text: Column) -> Column:
    """What python_reason finds keywords for; most files have none, so these are looked for first."""
    first = F.regexp_extract(text, f"^{WHITESPACE}*([^\\x00])", 1)
    return contains_any(text, python_keywords()) & (first != "{") & standard(text)


def c(text: Column, fused: bool = False) -> Column:
    """fused: two of the includes count only where they follow each other, as one keyword."""
    return standard(text) & contains_any(text, C_INCLUDES_FUSED if fused else C_INCLUDES)


def cpp(text: Column) -> Column:
    return standard(text, max_density=0.1) & contains_any(text, CPP_INCLUDES)


def julia_test(text: Column) -> Column:
    """A tenth of the lines has @test."""
    tests, lines = count_of(text, "@test"), count_of(text, "\n") + 1
    return (tests > 0) & (tests / lines >= 0.1)


def julia(text: Column, size: Column) -> Column:
    """No data file by its first character; large files must be tests of low density."""
    return (text != "") & ~F.substring(text, 1, 1).isin("%", "{", "[") & F.when(size >= 100_000, julia_test(text) & dense(text, 0.5)).otherwise(True)


def julia_strict(text: Column, size: Column) -> Column:
    return julia(text, size) & text.rlike("(?U)" + "|".join(f"\\W{w}\\W" for w in JULIA_WORDS))


def tex(text: Column, ext: Column, path: Column, english: Column) -> Column:
    return (ext == "tex") & standard(text, max_bytes=10_000_000) & ~F.contains(path, F.lit("latex/")) & ~F.contains(text, F.lit("gnuplot")) & contains_any(text, TEX_SECTIONS) & english


def notebook(text: Column) -> Column:
    return contains_any(F.lower(text), NOTEBOOK_WORDS)


def coq(text: Column) -> Column:
    return standard(text, blank=True) & contains_any(text, COQ_WORDS) & ~contains_any(text, VERILOG_WORDS) & ~F.contains(text, F.lit("This file was automatically generated"))


def lean(text: Column, repo: Column, path: Column) -> Column:
    return standard(text, blank=True) & contains_any(text, LEAN_WORDS) & ~repo.isin(LEAN_HELD_OUT) & ~F.contains(path, F.lit("_target/deps/"))


def isabelle(text: Column, repo: Column) -> Column:
    return standard(text, blank=True) & contains_any(text, ISABELLE_WORDS) & ~F.startswith(repo, F.lit("mirror-afp-2"))


def matlab(text: Column) -> Column:
    return standard(text, blank=True) & ~contains_any(text, [*OBJECTIVE_C_WORDS, "#include"]) & ~text.rlike(r"(?d) main\(.*\{$")


def generated(repo: Column) -> Column:
    return F.contains(repo, F.lit("generated")) | F.startswith(repo, F.lit("."))


@dataclass(frozen=True)
class LanguageSpec:
    """keep gets a function from a column's name to the column."""

    name: str
    keep: Callable[[Callable[[str], Column]], Column]
    converts: bool = False  # notebooks


def _of_text(rule: Callable[[Column], Column]):
    return lambda col: rule(col("content"))


STACK = {name: LanguageSpec(name, _of_text(standard)) for name in STACK_LANGUAGES} | {
    s.name: s
    for s in (
        LanguageSpec("r", _of_text(r)),
        LanguageSpec("maple", _of_text(maple)),
        LanguageSpec("haskell", _of_text(haskell)),
        LanguageSpec("python", _of_text(python)),
        LanguageSpec("c", _of_text(c)),
        LanguageSpec("cpp", _of_text(cpp)),
        LanguageSpec("julia", lambda col: julia(col("content"), col("size"))),
        LanguageSpec("tex", lambda col: tex(col("content"), col("ext"), col("max_stars_repo_path"), col("english"))),
        LanguageSpec("jupyter-notebook", _of_text(notebook), converts=True),
    )
}
GITHUB = {
    s.name: s
    for s in (
        LanguageSpec("coq", lambda col: coq(col("text"))),
        LanguageSpec("isabelle", lambda col: isabelle(col("text"), col("meta.repo"))),
        LanguageSpec("lean", lambda col: lean(col("text"), col("meta.repo"), col("meta.path"))),
        LanguageSpec("matlab", lambda col: matlab(col("text"))),
    )
}


def keep_language(df: DataFrame, language: str, specs: dict[str, LanguageSpec] = STACK) -> DataFrame:
    """Rows that the language's rule keeps; all of them for a language without one."""
    spec = specs.get(language)
    return df.where(spec.keep(F.col)) if spec else df
