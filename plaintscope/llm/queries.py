"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import functools
import os

from ..session import apply_required, ensure_checkpoint_dir
from .common import prepare, table
from .url_intervals import URL_SQL, active_entries, captures_of, entries_of
from .line_rules import QUALITY_SQL, quality_rules
from .divergence import DIVERGENCE_SQL, divergence

_QUERIES: dict = {}
_ORACLES: dict = {}


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_can_import(spark) -> None:
    """Local workers started elsewhere than in the repository find the package by the
    path the driver runs it from. A cluster ships it (--py-files or an installed wheel)."""
    env = spark.sparkContext.environment
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep) + env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH")) if x)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            apply_required(spark)
            ensure_checkpoint_dir(spark)
            workers_can_import(spark)
            prepare(spark)
            return fn(spark, sf_dir)
        _QUERIES[name] = run
        if oracle:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_ORACLES)


@register("op2_harmonic_packing")
def op2(spark, sf_dir):
    from .packing import pack_pieces
    return pack_pieces(table(spark, sf_dir, "documents")).drop("k")


@register("op5_token_files")
def op5(spark, sf_dir):
    from .token_files import read_documents, write_token_files
    return read_documents(write_token_files(table(spark, sf_dir, "documents"))).drop("part")


@register("op7_line_rules", oracle=QUALITY_SQL)
def op7(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).drop("row", "text_hash")


@register("op1_host_paths")
def op1(spark, sf_dir):
    from .host_paths import extract_pages
    return extract_pages(table(spark, sf_dir, "pages"))


@register("op8_toxicity")
def op8(spark, sf_dir):
    from .toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_suffix_family")
def op10(spark, sf_dir):
    from .suffix_family import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


@register("op9_ngram_join")
def op9(spark, sf_dir):
    from .ngram_join import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_url_intervals", oracle=URL_SQL)
def op3(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return active_entries(captures_of(pages), entries_of(pages))


@register("op4_product_quantiser")
def op4(spark, sf_dir):
    from .product_quantiser import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


@register("op6_viterbi_pieces")
def op6(spark, sf_dir):
    from .viterbi_pieces import piece_digest
    return piece_digest(table(spark, sf_dir, "documents"))


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    from .periodic_runs import periodic_runs, run_digest, with_planted_run
    return run_digest(periodic_runs(with_planted_run(table(spark, sf_dir, "documents"))))


@register("op12_scaled_sketch")
def op12(spark, sf_dir):
    from .scaled_sketch import compare_with_next
    return compare_with_next(table(spark, sf_dir, "documents"))


@register("op11_source_divergence", oracle=DIVERGENCE_SQL)
def op11(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))
