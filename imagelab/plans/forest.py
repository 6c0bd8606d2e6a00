"""A random forest that keeps nothing on disk: rows that memory does not hold are drawn again at each pass.

MLlib keeps its binned rows, each with a count for every tree, in memory and on local disks: about 4 bytes a
row and tree, which outgrow the input by far. Rows and counts follow from the written rows and the seed
alone, so they can as well be read and drawn again, with the same counts. The trees are those that MLlib
grows from its copy, and MLlib grows them here too.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_CLASSES = 100  # MLlib's own limit, where the label does not name its classes
POINT_BYTES = 96  # of a kept row, besides 4 for each feature and tree


class BoundedForest(RandomForestClassifier):
    """The forest of RandomForestClassifier, without its copy of the rows on disk.

    Rows that might come in another order when read again, such as those behind a shuffle, are kept as MLlib does.
    """

    def _fit_java(self, dataset: DataFrame):
        if self.isSet(self.weightCol) or self.isSet(self.thresholds):  # the steps below have neither
            return super()._fit_java(dataset)
        self._transfer_params_to_java()
        java, spark = self._java_obj, dataset.sparkSession
        ml = spark._jvm.org.apache.spark.ml
        label = self.getLabelCol()
        rows = dataset.withColumn(label, F.col(label).cast("double").alias(label, metadata=dataset.schema[label].metadata))._jdf
        java.transformSchema(rows.schema())  # complains of wrong columns

        classes = java.getNumClasses(rows, MOST_CLASSES)
        categories = ml.util.MetadataUtils.getCategoricalFeatures(rows.schema().apply(self.getFeaturesCol()))
        kind = spark._jvm.org.apache.spark.mllib.tree.configuration.Algo.Classification()
        strategy = java.getOldStrategy(categories, classes, kind, java.getOldImpurity())
        strategy.setBootstrap(self.getBootstrap())
        trees, subset, seed = self.getNumTrees(), self.getFeatureSubsetStrategy(), self.getSeed()

        instances = _module(ml.util, "DatasetUtils").extractInstances(java, rows, spark._jvm.scala.Option.apply(classes))
        grower = _module(ml.tree.impl, "RandomForest")
        metadata = ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, trees, subset)
        splits = grower.findSplits(instances, metadata, seed)
        binned = ml.tree.impl.TreePoint.convertToTreeRDD(instances, splits, metadata)
        bagging = _module(ml.tree.impl, "BaggedPoint")
        weight = getattr(bagging, "convertToBaggedRDD$default$5")()  # 1 for each row
        bagged = bagging.convertToBaggedRDD(binned, strategy.subsamplingRate(), trees, strategy.bootstrap(), weight, seed)
        bagged.setName("bagged tree points")
        levels = spark._jvm.org.apache.spark.storage.StorageLevel
        if bagged.outputDeterministicLevel().toString() != "DETERMINATE":
            bagged.persist(levels.MEMORY_AND_DISK())
        elif metadata.numExamples() * (POINT_BYTES + 4 * (metadata.numFeatures() + trees)) <= free_memory(spark):
            bagged.persist(levels.MEMORY_ONLY())
        shared = spark.sparkContext._jsc.broadcast(splits)
        none, most = spark._jvm.scala.Option.empty(), _module(ml.tree, "TreeConfig").trainingEarlyStopModelSizeThresholdInBytes()
        try:
            grown = grower.runBagged(bagged, metadata, shared, strategy, trees, subset, seed, none, True, none, most)
        finally:
            bagged.unpersist(False)
            shared.destroy()

        kinds, nothing = ml.classification, ml.param.ParamMap.empty()
        own = spark.sparkContext._gateway.new_array(kinds.DecisionTreeClassificationModel, len(grown))
        for i, tree in enumerate(grown):
            own[i] = java.copyValues(tree, nothing)
        model = kinds.RandomForestClassificationModel(java.uid(), own, own[0].numFeatures(), classes)
        java.copyValues(model, nothing).setParent(java)
        model.createSummary(rows)
        return model


def free_memory(spark: SparkSession) -> int:
    """Bytes of storage memory that are not in use, of all executors."""
    executors = spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()
    return sum(max(0, e.totalOnHeapStorageMemory() - e.usedOnHeapStorageMemory()) for e in executors)


def _module(package, name: str):
    """The single instance of a Scala object."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")
