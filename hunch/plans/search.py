"""End-to-end flows (R05, R06): questions in, fused and rendered results out.

One pass for all questions: decompose every question (token-table rules), build every
subquery and the boosted query, score all of them against the postings in one join,
keep the per-list top k, fuse per question, render. The reference's n+1 sequential
searches per question become two shuffles (score aggregate, fusion).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import annotate as A
from ..operators import decompose as D
from ..operators import fuse as U
from ..operators import present as P
from ..operators import rank as R
from ..operators.index import Index
from ..session import cut_lineage


@dataclass
class Flavour:
    """Parameters of a flow; the defaults are the main flow."""
    rrf_c: int = C.RRF_C_MAIN
    weighted_depth: int = C.WEIGHTED_DEPTH
    subquery_depth: int = C.SUBQUERY_DEPTH
    fused_depth: int = C.FUSED_DEPTH
    weighted_mode: str = "bag"          # 'bag' (the library's reading) or 'phrase' (the intent)
    escape_mode: str = "none"
    trim_mode: str = "fixed"
    with_attributes: bool = False
    boosts: dict = field(default_factory=lambda: {"entities": C.ENTITY_BOOST, "time": C.TIME_BOOST})


MAIN = Flavour()
COMPONENTS = Flavour(rrf_c=C.RRF_C_COMPONENTS, with_attributes=True)


def rule_decomposition(topics: DataFrame, trim_mode: str = "fixed") -> DataFrame:
    """Decompose every question with the rule annotator (N16 v2)."""
    ann = cut_lineage(A.annotate(topics), "annotations")   # read by ~10 rules
    return D.decompose(topics, ann, A.sentences(topics), trim_mode)


def attribute_boost(a: Column) -> Column:
    """Attributes in the listed set get 3, others 2."""
    return F.when(F.lower(a).isin(C.HIGH_BOOST_ATTRIBUTES), F.lit(C.ATTRIBUTE_BOOST_HIGH)) \
        .otherwise(F.lit(C.ATTRIBUTE_BOOST))


def weighted_query_text(norm: Column, entities: Column, time: Column, attributes: Column | None = None) -> Column:
    """``norm "entity"^4 ... "time"^2 ... ["attr"^3|2 ...]``."""
    parts = [F.array(norm),
             F.transform(entities, lambda e: F.format_string('"%s"^%d', e, F.lit(C.ENTITY_BOOST))),
             F.transform(time, lambda t: F.format_string('"%s"^%d', t, F.lit(C.TIME_BOOST)))]
    if attributes is not None:
        parts.append(F.transform(attributes, lambda a: F.format_string('"%s"^%d', a, attribute_boost(a))))
    return F.array_join(F.concat(*parts), " ")


def with_norm(decomp: DataFrame, escape_mode: str = "none") -> DataFrame:
    return decomp.withColumn("norm_query", T.normalize_query("query", escape_mode=escape_mode))


def list_table(decomp: DataFrame, fl: Flavour) -> DataFrame:
    """``(qid, sub_ord, kind, text)``: the boosted query as list 0, then N17's lists."""
    e = F.array().cast("array<string>")
    attrs = F.coalesce(F.col("attributes"), e) if fl.with_attributes else None
    w = decomp.select("qid", F.lit(0).alias("sub_ord"), F.lit("weighted").alias("kind"),
                      weighted_query_text(F.col("norm_query"), F.coalesce("entities", e), F.coalesce("time", e),
                                          attrs).alias("text"))
    return w.unionByName(D.subqueries(decomp, with_attributes=fl.with_attributes))


def bag_scores(lists: DataFrame, idx: Index, k: int) -> DataFrame:
    """BM25 scores of every list, the boosted list (0) included, of all documents that can be among the
    ``k`` best: the lists of all questions are scored in one pass over the documents."""
    return R.best_hits(R.query_terms(lists, stemmer=idx.stemmer), idx, k)


def ranked_lists(lists: DataFrame, idx: Index, fl: Flavour, decomp: DataFrame | None = None) -> DataFrame:
    """Every list scored at once: weighted list to depth 100, the others to 50. In
    ``phrase`` mode the weighted list is scored from the decomposition with exact
    phrases."""
    depth = F.when(F.col("sub_ord") == 0, F.lit(fl.weighted_depth)).otherwise(F.lit(fl.subquery_depth))
    if fl.weighted_mode == "bag":
        k = max(fl.weighted_depth, fl.subquery_depth)
        return R.top_k(bag_scores(lists, idx, k), k, depth=depth)
    from . import phrase
    subs = R.bm25_search(lists.filter(F.col("sub_ord") > 0), idx, k=fl.subquery_depth)
    w = phrase.boosted_phrase_hits(decomp, idx, fl.weighted_depth).withColumn("sub_ord", F.lit(0))
    return subs.select("qid", "sub_ord", "docid", "score", "rank").unionByName(
        w.select("qid", "sub_ord", "docid", "score", "rank"))


def search(topics: DataFrame, idx: Index | Callable[[], Index], fl: Flavour = MAIN, decomp: DataFrame | None = None) -> Flow:
    """Returns ``{'decomposition', 'lists', 'hits', 'fused', 'results'}`` (see ``Flow``).

    ``decomp`` swaps the decomposer: pass any table with ``qid, query, entities, time,
    descriptions, media_type[, attributes]``."""
    return Flow(topics, idx, fl, decomp)


class Flow(Mapping):
    """The parts of a flow by name, each made when it is first asked for, from those before it.

    A part is read more than once (a size check, then the join; several consumers of the
    hits and of the fused lists), so it is written once to the shared folder instead of being
    recomputed from the decomposition each time. A reader of the lists pays neither for
    the index (``idx`` may be a function that opens it) nor for the scores."""

    NAMES = ("decomposition", "lists", "hits", "fused", "results")

    def __init__(self, topics: DataFrame, idx: Index | Callable[[], Index], fl: Flavour, decomp: DataFrame | None):
        self._topics, self._idx, self._fl, self._decomp, self._parts = topics, idx, fl, decomp, {}

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._parts:
            self._parts[name] = getattr(self, f"_{name}")()
        return self._parts[name]

    def _index(self) -> Index:
        if not isinstance(self._idx, Index):
            self._idx = self._idx()
        return self._idx

    def _decomposition(self) -> DataFrame:
        d = rule_decomposition(self._topics, self._fl.trim_mode) if self._decomp is None else self._decomp
        return with_norm(d, self._fl.escape_mode)

    def _lists(self) -> DataFrame:
        return cut_lineage(list_table(self["decomposition"], self._fl), "lists")

    def _hits(self) -> DataFrame:
        return cut_lineage(ranked_lists(self["lists"], self._index(), self._fl, self["decomposition"]), "hits")

    def _fused(self) -> DataFrame:
        hits = self["hits"].select("qid", "sub_ord", "docid", "rank")
        return cut_lineage(U.rrf(hits, self._fl.rrf_c, self._fl.fused_depth), "fused")

    def _results(self) -> DataFrame:
        return P.render(self["fused"], self._index().corpus, self._topics)
