from featurekit.functions.stats import (  # noqa: F401
    bucket_of,
    exact_quantiles,
    guarded_corr,
    rint2,
    round6,
)
