"""The image-to-features step as an ML pipeline stage."""

from importlib import import_module

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imagelab.operators.images import embed, opened


class ImageFeaturizer(
    Transformer, HasInputCol, HasOutputCol, HasHandleInvalid, DefaultParamsReadable, DefaultParamsWritable
):
    """Adds a vector column with the features of an image column.

    `predictor` names a factory as `module:function`, so the stage can be saved and loaded.
    Images that cannot be processed are left out, or fail the job with handleInvalid="error".
    """

    predictor = Param(Params._dummy(), "predictor", "factory, module:function", TypeConverters.toString)
    height = Param(Params._dummy(), "height", "input height", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "input width", TypeConverters.toInt)
    method = Param(Params._dummy(), "method", "nearest, bilinear or bicubic", TypeConverters.toString)
    scaling = Param(Params._dummy(), "scaling", "none, inception or resnet", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str = "image",
        outputCol: str = "features",
        predictor: str = "imagelab.functions.predictors:grid_colour",
        height: int = 224,
        width: int = 224,
        method: str = "bicubic",
        scaling: str = "none",
        handleInvalid: str = "skip",
    ):
        super().__init__()
        self._setDefault(
            inputCol="image",
            outputCol="features",
            predictor="imagelab.functions.predictors:grid_colour",
            height=224,
            width=224,
            method="bicubic",
            scaling="none",
            handleInvalid="skip",
        )
        self._set(**self._input_kwargs)

    def embed_options(self) -> dict:
        """The settings of this stage, as arguments of `embed` and `feature_table`."""
        target, scaling = self.getOrDefault(self.predictor), self.getOrDefault(self.scaling)

        def factory():
            module, name = target.split(":")
            return getattr(import_module(module), name)()

        return {
            "make_predict_fn": factory,
            "height": self.getOrDefault(self.height),
            "width": self.getOrDefault(self.width),
            "method": self.getOrDefault(self.method),
            "scaling": None if scaling == "none" else scaling,
        }

    def _transform(self, dataset: DataFrame) -> DataFrame:
        embedded = opened(embed(self.getInputCol(), **self.embed_options()))
        found = dataset.select("*", embedded.alias("_features", "_reason"))
        features = F.col("_features")
        if self.getHandleInvalid() == "skip":
            found = found.filter(features.isNotNull())
        else:
            failure = F.raise_error(F.concat(F.lit("image without features: "), "_reason"))
            features = F.coalesce(features, failure.cast("array<float>"))
        return found.withColumn(self.getOutputCol(), array_to_vector(features)).drop("_features", "_reason")
