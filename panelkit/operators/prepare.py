"""Feature preparation as pipeline stages with read and write (A7 with F3-F5).

``PanelPreparer`` (Estimator) fits channel scalers, robust scalers of static columns and the category
dictionary on the rows it is given; ``PreparedPanel`` (Model) adds the temporal tensor and the static
features as a sparse vector.  Both save themselves: settings and fitted numbers as parameters,
the dictionary, which may be of any size, as a Parquet table beside them.  They work inside
``pyspark.ml.Pipeline`` and load in any session.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import categories as CAT
from panelkit.operators import features as FT
from panelkit.spec import PanelSpec


class _Settings(Params):
    """What to prepare, as JSON text: id columns, static columns, the panel and its channels."""

    settings = Param(Params._dummy(), "settings", "ids, cont, cat, spec, standard, robust", typeConverter=TypeConverters.toString)

    def wanted(self) -> dict:
        return json.loads(self.getOrDefault(self.settings))

    def spec(self) -> PanelSpec:
        raw = self.wanted()["spec"]
        return PanelSpec(raw["id_col"], raw["target"], tuple(raw["periods"]), {k: tuple(v) for k, v in raw["channels"].items()})


class PanelPreparer(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fits on the rows it is given; give it the training rows only."""

    @classmethod
    def of(cls, spec: PanelSpec, cont: list[str], cat: list[str], ids: list[str] | None = None, standard: tuple[str, ...] = ("status",),
           robust: tuple[str, ...] = ("bill", "pay")) -> "PanelPreparer":
        out = cls()
        out._set(settings=json.dumps({
            "ids": ids or [spec.id_col], "cont": list(cont), "cat": list(cat), "standard": list(standard), "robust": list(robust),
            "spec": {"id_col": spec.id_col, "target": spec.target, "periods": list(spec.periods), "channels": {k: list(v) for k, v in spec.channels.items()}}}))
        return out

    def _fit(self, train: DataFrame) -> "PreparedPanel":
        w = self.wanted()
        channels = FT.fit_channel_scalers(train, self.spec(), standard=tuple(w["standard"]), robust=tuple(w["robust"]))
        static = FT.fit_robust(train, w["cont"]) if w["cont"] else FT.ScalerParams()
        return PreparedPanel.of(self.getOrDefault(self.settings), channels, static, CAT.fit_dictionary(train, w["cat"]))


class PreparedPanel(Model, _Settings, MLReadable, MLWritable):
    """Adds ``temporal`` (periods x channels) and ``static_size``, ``static_indices``, ``static_values``; all other columns stay."""

    fitted = Param(Params._dummy(), "fitted", "centres and scales", typeConverter=TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self.dictionary: CAT.Dictionary | None = None

    @classmethod
    def of(cls, settings: str, channels: FT.ScalerParams, static: FT.ScalerParams, dictionary: CAT.Dictionary) -> "PreparedPanel":
        out = cls()
        out._set(settings=settings, fitted=json.dumps({"channels": vars(channels), "static": vars(static)}))
        out.dictionary = dictionary
        return out

    def copy(self, extra=None) -> "PreparedPanel":
        out = super().copy(extra)
        out.dictionary = self.dictionary
        return out

    def scalers(self) -> tuple[FT.ScalerParams, FT.ScalerParams]:
        raw = json.loads(self.getOrDefault(self.fitted))
        return FT.ScalerParams(**raw["channels"]), FT.ScalerParams(**raw["static"])

    def parameter_table(self, spark) -> DataFrame:
        """(stage, name, center, scale): the fitted numbers as a table."""
        channels, static = self.scalers()
        rows = [(stage, n, p.center[n], p.scale[n]) for stage, p in (("channel", channels), ("static", static)) for n in p.center]
        return spark.createDataFrame(rows, "stage string, name string, center double, scale double")

    def _transform(self, df: DataFrame) -> DataFrame:
        w, (channels, static) = self.wanted(), self.scalers()
        vectors = CAT.sparse_representation(df, w["ids"], w["cont"], static, self.dictionary)
        vectors = vectors.select(*w["ids"], F.col("size").alias("static_size"), F.col("indices").alias("static_indices"), F.col("values").alias("static_values"))
        tensor = FT.temporal_representation(self.spec(), channels, channels=tuple(w["standard"] + w["robust"]))
        return df.withColumn("temporal", tensor).join(vectors, w["ids"])

    def write(self) -> "_Writer":
        return _Writer(self)

    @classmethod
    def read(cls) -> "_Reader":
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: PreparedPanel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        CAT.save_dictionary(self.instance.dictionary, f"{path}/dictionary")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> PreparedPanel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls()
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        out.dictionary = CAT.load_dictionary(self.sparkSession, f"{path}/dictionary", out.wanted()["cat"])
        return out
