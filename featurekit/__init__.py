"""featurekit: fit/transform feature preparation and binary-classifier evaluation on Spark."""

from featurekit.operators import *  # noqa: F401,F403
from featurekit.plans.chain import FeatureChain, FeatureChainModel  # noqa: F401
from featurekit.plans.evaluate import best_flags, confusion, roc_auc, threshold_sweep  # noqa: F401
from featurekit.plans.persist import load_model, save_model  # noqa: F401
from featurekit.plans.search import halving_search, split_stability  # noqa: F401
from featurekit.plans.split import downsample, prepare, stratified_split  # noqa: F401
