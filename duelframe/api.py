"""One import for users: every operator by its SURVEY name.

    from duelframe.api import career_windows, best_match_join, nearest_names
"""

from duelframe.functions.keys import (  # noqa: F401  F1-F8, F14-F16
    add_days, city_of, country_code, country_of, digits_and_dot, digits_only, elevation_m,
    expand_abbreviations, normalize_name, pair_key, parse_mdy, parse_ymd, place_key,
    transliterate,
)
from duelframe.functions.numeric import (  # noqa: F401  F17-F21, A22
    abs_percent, add_ratios, fill_category, fill_zero, finite_or_max, floor_half, nan_to_null,
    row_mean, safe_ratio,
)
from duelframe.functions.text import (  # noqa: F401  F9-F13, F22-F24
    absolute_url, edit_distance, indel_ratio, is_blank, lcs_length, outcome_detail,
    outcome_method, row_json, strip_parens,
)
from duelframe.operators.aggs import (  # noqa: F401  A1-A10, A13-A15, A20
    column_stats, distinct_values, exact_quantiles, five_number, group_count, group_mean,
    has_null, label_correlation, mean_over_runs, median_over_folds, null_profile, null_totals,
    shape, value_counts, value_counts_multi,
)
from duelframe.operators.bouts import combine_bouts  # noqa: F401  the joining flow (SURVEY 3.1)
from duelframe.operators.joins import (  # noqa: F401  J1-J6, J8-J13, A11, A12
    argmin, best_match_join, broadcast_if_small, dedupe_first, forward_date,
    forward_date_join, join_suffixed, location_join, lookup, pair_join, reattach, unmatched,
    update_from, upsert, zip_rows,
)
from duelframe.operators.metrics import (  # noqa: F401  A16-A19
    accuracy, binary_metrics, confusion_matrix, f1_per_class, macro_f1,
)
from duelframe.operators.models import (  # noqa: F401  M8-M16, M18-M21
    as_features, bernoulli_nb, compare_models, evaluate, grid_search, knn_classify, knn_neighbours,
    linear_svm, logreg, mlp, pca, predict_horizons, random_forest, rank_results,
    mean_confusion, repeat_eval, repeat_predictions, rfe, tune_knn,
)
from duelframe.operators.selection import (  # noqa: F401  M4, M15, M16 in evaluation
    Elimination, principal_components, reduced, scaled,
)
from duelframe.operators.name_index import nearest_names  # noqa: F401  J7
from duelframe.operators.names import threshold_pairs  # noqa: F401
from duelframe.operators.ordering import (  # noqa: F401  O3-O7, P17
    global_row_number, key_row_number, preview, reverse_order, shuffle_rows, top_half, top_k,
)
from duelframe.operators.prep import (  # noqa: F401  M1-M7, M17, M22-M24
    category_codes, clean_competitors, encode_auto, feature_set, label_encode, minmax, one_hot, one_hot_vector,
    prepare_careers, select_correlated, sparse_entries, split, split_stratified, standardize,
)
from duelframe.operators.project import (  # noqa: F401  P1-P19
    binary_label, columns_by_type, drop_blank, drop_columns, drop_value, if_column,
    int_or_null, null_rows, rename, replace_where, select_matching, split_label,
    strip_prefix, try_cast, winner_loser, with_row_id,
)
from duelframe.operators.reshape import (  # noqa: F401  U1-U6
    array_to_columns, distinct_names, explode_list, split_sides, stack_columns, union_all,
)
from duelframe.operators.windows import (  # noqa: F401  W1-W10
    career_windows, chunk, flatten_windows, has_hot_key, impute_group_mean, kfold,
    label_columns, top_n_per_group, unchunk, with_min_rows,
)
from duelframe.sources.io import (  # noqa: F401  S1-S7
    from_records, literal_table, read_lines, read_table, records_from_json, write_lines,
    write_table,
)
from duelframe.sources.pages import (  # noqa: F401  S8-S11, X4
    page_elements, page_field, page_items, page_labelled, page_links, page_records,
)
