from . import fair, kmeans, objective, words
from .fair import (assign_by, cluster_group_stats, fair_centers, fair_lloyd, fair_lloyd_by, fair_params, fair_step,
                   fixed_costs, line_search, repair_empty)
from .kmeans import kmeans_centers, lloyd, lloyd_step
from .objective import (assign, center_stats, cluster_costs, cluster_group_counts, compare,
                        evaluate, fair_objective, group_mean_costs, point_distances,
                        report, standard_objective)
from .words import avg_word_length, distinct_words, num_docs, per_doc_counts, word_counts

__all__ = [
    "fair", "kmeans", "objective", "words",
    "assign_by", "cluster_group_stats", "fair_centers", "fair_lloyd", "fair_lloyd_by", "fair_params", "fair_step", "fixed_costs",
    "line_search", "repair_empty", "kmeans_centers", "lloyd", "lloyd_step", "assign",
    "center_stats", "cluster_costs", "cluster_group_counts", "compare", "evaluate",
    "fair_objective", "group_mean_costs", "point_distances", "report", "standard_objective",
    "avg_word_length", "distinct_words", "num_docs", "per_doc_counts", "word_counts",
]
