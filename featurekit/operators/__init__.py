from featurekit.operators.base import Stage, StageModel, Stateless  # noqa: F401
from featurekit.operators.clip import RobustScale, SigmaClip, TukeyClip  # noqa: F401
from featurekit.operators.columns import DropColumns, KeepColumns  # noqa: F401
from featurekit.operators.correlation import CorrelationPruner, correlation_pairs  # noqa: F401
from featurekit.operators.knn import KnnClassifier, KnnImpute  # noqa: F401
from featurekit.operators.mapping import ValueMapper, mapping_coverage  # noqa: F401
from featurekit.operators.onehot import OneHot  # noqa: F401
from featurekit.operators.target import TargetEncode  # noqa: F401
