"""Training rows for the forests: employees of a company and as many others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.operators.encoding import encode
from fitlens.operators.sampling import negatives
from fitlens.session import stored


def training_rows(population: DataFrame, org_types: DataFrame, seed: int) -> DataFrame:
    """Positives and drawn negatives of every company with encoded features and a 0/1 label.

    population(company_name, id, top_university, volunteering, average_months_of_experience,
    degree) has one row per person, so features are joined by ``id`` without repeats.
    org_types(id, company_name, organization_type) gives the organisation types text.
    """
    population = stored(population)
    features = population.drop("company_name", "doctorate", "master")
    # One blank-ended name per employer, in order of the types; counted per type before they meet.
    times = org_types.dropna(subset=["organization_type"]).groupBy("id", "organization_type").agg(F.count("*").alias("n"))
    names = F.expr("repeat(concat(organization_type, ' '), cast(n as int))")
    text = times.groupBy("id").agg(F.array_join(F.sort_array(F.collect_list(names)), "").alias("organization_types"))
    features = features.join(text, "id", "left").fillna("", subset=["organization_types"])
    own = population.select("company_name", "id").withColumn("label", F.lit(1))
    drawn = negatives(own, "company_name", "id", seed).withColumn("label", F.lit(0))
    # Stored, so that negatives are drawn once: the encoding reads the rows for its strings and again for their numbers.
    return encode(stored(own.unionByName(drawn).join(features, "id")))
