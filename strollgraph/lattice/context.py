"""Inputs and stage tables of one lattice, shared by the registered queries.

Stages, and the inputs that many of them read, are checkpointed once per application and data folder, as a production run would write
them as tables; ``forget`` drops them so that a timing starts cold.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strollgraph.lattice import tables as T
from strollgraph.operators import labels as L
from strollgraph.operators import sites as D
from strollgraph.plans import analyse as A
from strollgraph.session import cut, tune

_CONTEXTS: dict[tuple[str, str], "Lattice"] = {}


class Lattice:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return T.table(self.spark, self.sf_dir, name)

    @cached_property
    def land(self) -> DataFrame:
        return cut(T.land(self.spark, self.sf_dir))

    @cached_property
    def routes(self) -> DataFrame:
        return cut(T.routes(self.spark, self.sf_dir))

    @cached_property
    def barriers(self) -> DataFrame:
        return cut(T.barriers(self.spark, self.sf_dir))

    @cached_property
    def hints(self) -> DataFrame:
        return T.hints(self.spark, self.sf_dir)

    @cached_property
    def councils(self) -> DataFrame:
        return T.councils(self.spark, self.sf_dir)

    @cached_property
    def counties(self) -> DataFrame:
        return T.counties(self.spark, self.sf_dir)

    @cached_property
    def way_nodes(self) -> DataFrame:
        return T.way_nodes(self.spark, self.sf_dir)

    @cached_property
    def reviews(self) -> DataFrame:
        return T.reviews(self.spark, self.sf_dir)

    @cached_property
    def settings(self) -> A.Settings:
        return A.Settings(tolerance_m=T.TOLERANCE_M, min_candidate_area_m2=T.MIN_AREA_M2)

    @cached_property
    def catalogue(self) -> D.Catalogue:
        made = D.form_sites(self.land)
        return replace(made, membership=cut(made.membership), outline=cut(made.outline))

    @cached_property
    def inputs(self) -> A.Inputs:
        return A.Inputs(
            catalogue=self.catalogue, routes=self.routes, barriers=self.barriers, counties=self.counties,
            councils=self.councils, gaps=self.councils.where("is_gap"), hints=self.hints,
        )

    @cached_property
    def shapes(self) -> DataFrame:
        return cut(A.graph_shapes(self.catalogue, self.hints))

    @cached_property
    def site_shapes(self) -> DataFrame:
        return self.shapes.where("official_site")

    @cached_property
    def graph(self) -> A.Graph:
        return A.build_graph(self.inputs, self.settings, self.shapes)

    @cached_property
    def classified(self) -> DataFrame:
        return cut(A.classify(self.inputs, self.graph, self.settings))

    @cached_property
    def authority_labels(self) -> tuple[DataFrame, DataFrame]:
        county, council = A.authority_labels(self.catalogue, self.site_shapes, self.counties, self.councils)
        return cut(county), cut(council)

    @cached_property
    def labelled(self) -> DataFrame:
        """Classified sites with labels, points, regimes and the rest of the report columns."""
        return cut(A.label(self.classified, self.inputs, self.graph, self.settings, labels=self.authority_labels))

    @cached_property
    def site_numbers(self) -> DataFrame:
        """Whole-number area per site, for reports that order by it."""
        return self.labelled.withColumn("area_ha", F.round("area_ha", 6))

    @cached_property
    def status_numbers(self) -> DataFrame:
        """``site_numbers`` for reports on the status alone: nothing is labelled or searched for them."""
        return self.classified.withColumn("area_ha", F.round("area_ha", 6))

    def with_authorities(self, sites: DataFrame) -> DataFrame:
        """Sites with their county and council, without the searches of ``labelled``."""
        return L.add_labels(sites, *self.authority_labels)


def lattice(spark: SparkSession, sf_dir: str) -> Lattice:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Lattice(spark, sf_dir)
    return _CONTEXTS[key]


def forget() -> None:
    _CONTEXTS.clear()
