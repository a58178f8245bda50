"""Fixed values that results depend on.

These must equal the values the original notebooks use, so they are kept
together, plainly, in natural order.
"""

# --- fixed values: ordinal levels, lowest to highest (score 1..n, unknown -> 0)
CUT_LEVELS = ["Fair", "Good", "Very Good", "Premium", "Ideal"]
COLOR_LEVELS = ["J", "I", "H", "G", "F", "E", "D"]
CLARITY_LEVELS = ["I1", "SI2", "SI1", "VS2", "VS1", "VVS2", "VVS1", "IF"]

# --- fixed values: interval and calibration settings
GAUSS_Z = 1.96              # Gaussian 95% multiplier
CREDIBLE_K = 2.0            # Monte Carlo interval: mean +/- 2 std
CONFORMAL_ALPHA = 0.05      # split conformal miscoverage
QUANTILE_ALPHAS = (0.05, 0.95)
TEMPERATURE_BATCH = 256     # validation batch size of the batched temperature fit

# --- fixed values: verdict thresholds
COVERAGE_LOW, COVERAGE_HIGH = 0.90, 0.99          # Gaussian / conformal coverage
REPORT_TARGET, REPORT_TOLERANCE = 0.90, 0.05      # quantile-pair report card
SPREAD_LOW, SPREAD_HIGH = 0.01, 1.0               # posterior mean std, log scale
SKEW_LIMIT = 1.0                                  # |skewness| above this is skewed

# --- fixed values: verdict labels
COVERAGE_VERDICTS = ("over-confident", "well calibrated", "under-confident")
SPREAD_VERDICTS = ("collapsed", "healthy", "exploding")
SKEW_VERDICTS = ("skewed left", "symmetric", "skewed right, log-transform advised")
REPORT_VERDICTS = ("good", "needs calibration")
ROW_VERDICTS = ("FAILURE", "SUCCESS")
TRUST_LABELS = ("normal", "uncommon")

# --- fixed values: model shapes and training defaults
VARIATIONAL_LAYERS = (64, 32)       # hidden widths of the variational net
VARIATIONAL_STEPS = 2000
MEANVAR_LAYERS = (128, 64)          # shared trunk of the mean / log-variance net
MEANVAR_STEPS = 2000
ADAM_RATE = 0.005
RHO_INIT = -3.0                     # initial rho of every variational weight
MU_INIT = 0.1                       # initial mu ~ U(-0.1, 0.1)
MC_DRAWS = 100
BOOST_ROUNDS, BOOST_RATE, BOOST_DEPTH = 100, 0.1, 5
FOREST_TREES, FOREST_SAMPLE, CONTAMINATION = 100, 256, 0.05
KMEANS_K, KMEANS_STARTS = 50, 10
SEED = 42
HIST_BINS = 30
KDE_GRID = 200
