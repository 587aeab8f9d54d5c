"""Views from stage specs: ``[{"type": "Match", "filter": "score > 0.5"}, ...]``."""

from __future__ import annotations

import inspect
from collections.abc import Mapping, Sequence

from ..dataset import Dataset


def _stage_functions() -> dict:
    from . import evaluation, fields, labels, ordering, samples, similarity

    # The stage names users write in specs.
    return {
        "ExcludeFields": fields.exclude_fields,
        "Exists": samples.exists,
        "FilterField": samples.filter_field,
        "FilterLabels": labels.filter_labels,
        "GroupBy": ordering.group_by,
        "Limit": ordering.limit,
        "LimitLabels": labels.limit_labels,
        "MapLabels": labels.map_labels,
        "Match": samples.match,
        "MatchLabels": samples.match_labels,
        "MatchTags": samples.match_tags,
        "Select": samples.select,
        "SelectBy": samples.select_by,
        "SelectFields": fields.select_fields,
        "SelectGroupSlices": samples.select_group_slices,
        "SelectLabels": labels.select_labels,
        "Shuffle": ordering.shuffle,
        "Skip": ordering.skip,
        "SortBy": ordering.sort_by,
        "SortBySimilarity": similarity.sort_by_similarity,
        "Take": ordering.take,
        "ToEvaluationPatches": evaluation.to_evaluation_patches,
        "ToPatches": labels.to_patches,
    }


def apply_stages(ds: Dataset, specs: Sequence[Mapping]) -> Dataset:
    """Apply stage specs in order.

    A spec's parameters are the keyword arguments of the stage's function. All specs
    are checked before the first one is applied, and an error names the stage's index.
    A bad stage raises: it never falls back to the unfiltered dataset.
    """
    known = _stage_functions()
    calls = []
    for index, spec in enumerate(specs):
        params = dict(spec)
        kind = params.pop("type", "")
        if kind not in known:
            raise ValueError(
                f"stage {index}: unknown type '{kind}', expected one of {', '.join(known)}"
            )
        try:
            inspect.signature(known[kind]).bind(ds, **params)
        except TypeError as error:
            raise ValueError(f"stage {index} ({kind}): {error}") from error
        calls.append((index, kind, params))
    for index, kind, params in calls:
        try:
            ds = known[kind](ds, **params)
        except Exception as error:
            raise ValueError(f"stage {index} ({kind}): {error}") from error
    return ds


def viewed(ds: Dataset, stages: Sequence[Mapping] | None) -> Dataset:
    return apply_stages(ds, stages) if stages else ds
