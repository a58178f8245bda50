"""Name -> query callable (spark, folder) -> DataFrame."""

from __future__ import annotations

from bandwise.plans import bayes
from bandwise.plans import calibration as cal
from bandwise.plans import preparation as prep
from bandwise.plans import nets, spatial, trees


def all_queries() -> dict:
    return {
        "calibration_chain": cal.calibration_chain,
        # phase 2: preparation
        "positive_filter": prep.positive_filter_rows,
        "csv_round_trip": prep.csv_round_trip,
        "ordinal_encode": prep.ordinal_encode_rows,
        "assembled_features": prep.assembled_features,
        "hash_split_counts": prep.hash_split_counts,
        "standardize_train_stats": prep.standardize_train_stats_rows,
        "standardized_check": prep.standardized_check,
        "target_transform": prep.target_transform_rows,
        "drop_select": prep.drop_select_rows,
        # phase 3: statistics and plot tables
        "skew_audit": prep.skew_audit_rows,
        "width_histogram": prep.width_histogram,
        "target_histogram": prep.target_histogram,
        "density_curve": prep.density_curve_rows,
        "spearman_width_error": cal.spearman_width_error,
        "order_stat_quantile": prep.order_stat_quantile,
        "top_by_truth": cal.top_by_truth,
        "sample_sorted_band": cal.sample_sorted_band,
        "error_width_points": cal.error_width_points,
        "mc_sample_bars": bayes.mc_sample_bars,
        # phase 4: intervals and calibration
        "gaussian_interval": cal.gaussian_interval_rows,
        "group_quantile_interval": prep.group_quantile_interval,
        "nll_before_after": cal.nll_before_after_report,
        "mse_report": cal.mse_report,
        "crossing_intervals": trees.crossing_intervals,
        "temperature_scale": cal.temperature_scale,
        "temperature_batched": cal.temperature_batched,
        "conformal_interval": cal.conformal_interval,
        "conformal_by_segment": cal.conformal_by_segment,
        "asymmetric_bars": cal.asymmetric_bars_rows,
        # phase 5: audits
        "coverage_verdict": cal.coverage_verdicts,
        "sharpness_audit": cal.sharpness_report,
        "report_card": prep.report_card_rows,
        "row_verdict": cal.row_verdicts,
        "single_row_verdict": cal.single_row_verdict,
        "spread_diagnosis": bayes.spread_diagnosis_report,
        # phase 6: linear variational model
        "linear_posterior": bayes.linear_posterior,
        "posterior_kl": bayes.posterior_kl_report,
        "mc_predictive_linear": bayes.mc_predictive_linear,
        "credible_interval": bayes.credible_interval_rows,
        # phase 7: spatial feature
        "nearest_center": spatial.nearest_center_rows,
        "kmeans_feature": spatial.kmeans_feature,
        # phase 8: trees
        "gbt_mean": trees.gbt_mean,
        "quantile_boost": trees.quantile_boost,
        "quantile_report_card": trees.quantile_report_card,
        # phase 9: anomaly
        "isolation_scores": trees.isolation_scores,
        "combined_scan": trees.combined_scan,
        "enhanced_scan": trees.enhanced_scan,
        "enhanced_report_card": trees.enhanced_report_card,
        "anomaly_flags": trees.anomaly_flags,
        # phase 10: nets, data-parallel
        "variational_net": nets.variational_net,
        "net_training_log": nets.net_training_log,
        "mean_logvar_net": nets.mean_logvar_net,
        "mean_logvar_coverage": nets.mean_logvar_coverage,
        "mean_logvar_linear": nets.mean_logvar_linear,
    }
