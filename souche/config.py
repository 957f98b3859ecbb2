"""Thresholds of the grouping pipelines, in one typed place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Surnames:
    least_lemma: int = 3
    most_links: int = 15
    jw_least: float = 0.75
    final_least: float = 0.55
    length_cap: int = 15
    prefix: int = 2
    top_k: int = 40
    tfidf_weight: float = 0.5
    language_weight: float = 0.3
    place_weight: float = 0.2


@dataclass(frozen=True)
class FirstNames:
    most_cited: int = 8
    knn_least: float = 0.88
    k: int = 50
    final_least: float = 0.92
    language_bonus: float = 0.04
    place_bonus: float = 0.02
    generic_text: int = 20
    radical_names: int = 5
    shortest_name: int = 4
    least_tokens: int = 5
    centroid_least: float = 0.88
    outlier_under: float = 0.82
    outlier_most: int = 30


@dataclass(frozen=True)
class Preparation:
    most_links: int = 15
