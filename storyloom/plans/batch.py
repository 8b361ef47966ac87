"""The batch digest job: candidates -> story groups -> ranking -> top N."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.operators.arrival import with_arrival_order
from storyloom.operators.grouping import assign_groups, grouping_items
from storyloom.operators.materialize import collect_garbage, materialize
from storyloom.operators.ranking import rank_keys, top_groups, with_texts
from storyloom.params import DigestParams


def group_stories(candidates: DataFrame, params: DigestParams, exact: bool = True,
                  digest_key: str | None = None, use_ratio: bool | None = None) -> DataFrame:
    """Candidates with ``ord``, ``digest_key`` and ``leader_ord``."""
    ordered = with_arrival_order(candidates)
    # read many times below: the title keys are made once, and the texts are not read again for them
    items = materialize(grouping_items(ordered, digest_key), "grouping-items")
    collect_garbage(candidates.sparkSession)  # the shuffles that read and sorted the texts
    groups = assign_groups(items, params.similarity_threshold,
                           params.use_ratio_edges if use_ratio is None else use_ratio,
                           exact=exact)
    dk = F.lit("") if digest_key is None else F.coalesce(F.col(digest_key).cast("string"), F.lit(""))
    return ordered.withColumn("digest_key", dk).join(
        groups.select("ord", "leader_ord"), "ord")


def select_top_stories(candidates: DataFrame, params: DigestParams, exact: bool = True,
                       digest_key: str | None = None,
                       use_ratio: bool | None = None) -> DataFrame:
    """Group, rank, keep the top ``max_news_count`` per digest key."""
    members = group_stories(candidates, params, exact, digest_key, use_ratio)
    # texts and links are fetched for the groups that are on board only
    top = materialize(top_groups(rank_keys(members), params.max_news_count), "top-keys")
    return with_texts(top, members)


def digest_documents(candidates: DataFrame, top: DataFrame, display_time: str,
                     digest_key: str | None = None) -> DataFrame:
    """R1-R4 (+ S13): ``(digest_key, document)``; a key without items gets the
    fixed empty text."""
    from storyloom.operators.digest import assemble, digest_lines
    from storyloom.operators.stats import candidate_stats
    stats = candidate_stats(candidates, digest_key)
    return assemble(digest_lines(top, stats, display_time))


def run_digest(candidates: DataFrame, params: DigestParams, display_time: str,
               exact: bool = True, digest_key: str | None = None) -> DataFrame:
    """The whole selection: S13 empty branch, else C8 -> R4."""
    from storyloom.operators.digest import empty_digest
    from storyloom.operators.stats import candidate_stats
    if candidates.isEmpty():
        return empty_digest(candidate_stats(candidates, digest_key))
    top = select_top_stories(candidates, params, exact=exact, digest_key=digest_key)
    return digest_documents(candidates, top, display_time, digest_key)


def run_job(raw: DataFrame, params: DigestParams, history_path: str, out_path: str, run: str,
            pages: DataFrame | None = None, call=None, client_factory=None, body_fn=None,
            exact: bool = True, digest_key: str | None = None, ledger: str | None = None) -> DataFrame:
    """One whole run: expire the stored history (S10), drop published links
    (J1), select (C8), have the top N summarised by the model (F9-F10, if a
    client and pages are given; replies are kept in the ``ledger`` folder, if one is named), write the digests under ``run`` (S11) and
    append what was published to the history (S9).

    ``raw``: raw article records, usually the union of feeds and search.
    Returns ``(digest_key, document)``. The tables between the steps are
    written once; :func:`storyloom.operators.materialize.release` deletes
    them when the caller is done.
    """
    from storyloom.operators.digest import display_time_text, empty_digest, write_digests
    from storyloom.operators.enrich import enhance
    from storyloom.operators.filters import prepare_candidates
    from storyloom.operators.history import append_history, expire_stored, read_history
    from storyloom.operators.stats import candidate_stats

    spark = raw.sparkSession
    expire_stored(spark, history_path, params.as_of, params.history_days)
    history = read_history(spark, history_path)
    candidates = materialize(prepare_candidates(raw, params, history), "candidates")
    if candidates.isEmpty():
        docs = materialize(empty_digest(candidate_stats(candidates, digest_key)), "documents")
        write_digests(docs, out_path, run)
        return docs
    top = materialize(select_top_stories(candidates, params, exact, digest_key), "top")
    if call is not None or client_factory is not None:
        top = materialize(enhance(top, pages, params, call, body_fn, client_factory, ledger), "enhanced")
    docs = materialize(digest_documents(candidates, top, display_time_text(params.as_of), digest_key), "documents")
    write_digests(docs, out_path, run)
    append_history(top, history_path, params.as_of)
    return docs
