"""samplecraft: curating labelled sample datasets on Spark."""

from .dataset import Dataset, FieldNotFound, resolve_path
from .operators.aggregations import (
    bounds,
    count_values,
    count_values_totals,
    distinct,
    distinct_count,
    get_values,
    histogram_values,
    mean,
    measures,
    std,
    sum,
)
from .operators.evaluation import (
    accuracy,
    classification_report,
    confusion_counts,
    detection_report,
    evaluate_by_slice,
    evaluate_classification,
    evaluate_detections,
    store_evaluation,
    to_evaluation_patches,
)
from .operators.facets import facet_filter
from .operators.fields import exclude_fields, select_fields
from .operators.labels import (
    filter_labels,
    limit_labels,
    map_labels,
    select_labels,
    to_patches,
)
from .operators.mutations import (
    Change,
    add_samples,
    clone_field,
    count_sample_tags,
    remap_values,
    set_values,
    tag_samples,
    untag_samples,
)
from .operators.ordering import (
    group_by,
    group_members,
    limit,
    page,
    shuffle,
    skip,
    sort_by,
    take,
    with_position,
)
from .operators.quality import find_issues
from .operators.samples import (
    exists,
    filter_field,
    filter_view,
    match,
    match_labels,
    match_tags,
    select,
    select_by,
    select_group_slices,
)
from .operators.schema import add_sample_field, get_field_schema, infer_fields
from .operators.similarity import knn_join, near_duplicates, sort_by_similarity, uniqueness
from .operators.stages import apply_stages
from .sources.catalog import (
    UnknownDataset,
    clone_dataset,
    dataset_info,
    dataset_summary,
    export_samples,
    import_samples,
    list_datasets,
    load_dataset,
    load_view,
    save_view,
    summary_value_counts,
)
from .sources.similarity_index import SimilarityIndex, build_similarity_index, open_similarity_index
from .sources.versions import Store, create_store, open_store
