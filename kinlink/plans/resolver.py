"""The whole pipeline: normalize, block, compare, classify, list."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from kinlink.operators.blocking import BlockingConfig, generate_candidates
from kinlink.operators.features import entities, entity_features, target_union
from kinlink.operators.pairs import label_join, pair_features
from kinlink.plans.model import THRESHOLD, predict_match, train
from kinlink.session import cut
from kinlink.sources.tsv import results


@dataclass
class EntityResolver:
    """fit() learns from source tables and truth pairs (s1_id, target_id); transform() gives both result tables.

    The features of each table are computed once and kept in the checkpoint folder: blocking and comparison both read them.
    """

    config: BlockingConfig = field(default_factory=BlockingConfig)
    model_type: str = "histgb"
    threshold: float = THRESHOLD
    model: PipelineModel | None = None
    summary: dict = field(default_factory=dict)

    def prepared(self, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> tuple[DataFrame, DataFrame]:
        make = lambda e: cut(entity_features(e, self.config.mode, self.config.n))
        return make(entities(s1)), make(target_union(s2, s3))

    def pairs(self, a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
        candidates = cut(generate_candidates(a, b, self.config))
        return candidates, pair_features(candidates, a, b, self.config.n)

    def fit(self, s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, **overrides) -> "EntityResolver":
        a, b = self.prepared(s1, s2, s3)
        _, features = self.pairs(a, b)
        self.model, self.summary = train(cut(label_join(features, truth)), self.model_type, **overrides)
        return self

    def transform(self, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> dict[str, DataFrame]:
        """matching_results and candidate_pairs, one row for each source 1 record in its order."""
        if self.model is None:
            raise ValueError("fit() or load a model first")
        a, b = self.prepared(s1, s2, s3)
        candidates, features = self.pairs(a, b)
        matched = predict_match(self.model, features, self.threshold)
        return {"matching_results": results(a, matched, "matched_entity_ids"), "candidate_pairs": results(a, candidates, "candidate_entity_ids")}
