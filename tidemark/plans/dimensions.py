"""Dimensions built from code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import keys as k
from tidemark.functions.periods import DateLike
from tidemark.operators.joins import dealt
from tidemark.operators.latest import valid_at
from tidemark.operators.shaping import with_unknown_member


def segment_dimension(
    members: DataFrame,
    segments: DataFrame,
    sub_segments: DataFrame,
    date: DateLike,
    leave_out: Sequence[str] = (),
) -> DataFrame:
    """Every segment and sub-segment in use, labelled, with a surrogate key and an unknown
    member.

    ``members(segment, sub_segment, product_line)``; ``segments(segment, label, dfval)`` and
    ``sub_segments(sub_segment, sub_label, dfval)``, of which the rows valid at ``date``
    count.  Product lines in ``leave_out`` and members without both labels are no members.
    The distinct members are taken before the joins: they are few however many rows use
    them.
    """
    used = members.select("segment", "sub_segment", "product_line").distinct()
    labels = valid_at(segments, date).select("segment", "label").distinct()
    sub_labels = valid_at(sub_segments, date).select("sub_segment", "sub_label").distinct()
    named = used.join(labels, "segment").join(sub_labels, "sub_segment")
    kept = named.where(F.col("product_line").isNotNull() & ~F.col("product_line").isin(*leave_out))
    columns = ["segment", "sub_segment", "product_line", "label", "sub_label"]
    member = with_unknown_member(kept.select(*columns))
    return member.withColumn("segment_key", k.surrogate_key("segment", "sub_segment"))


def contract_graph(
    accounts: DataFrame,
    links: DataFrame,
    elements: DataFrame,
    contracts: DataFrame,
    holders: DataFrame,
    contract_types: DataFrame,
    element_types: DataFrame,
    date: DateLike,
) -> DataFrame:
    """From accounts over contract elements and contracts to their main holders.

    ``accounts(account, element)``, ``links(element, linked)``: the elements an account's
    element works with; ``elements(element, contract, product)``, ``contracts(contract,
    contract_type, state)``, ``holders(contract, holder, main)``; the two type tables have
    ``contract_type`` or ``product`` and ``dfval``, and only types valid at ``date`` count.

    An account reaches its own element and the linked ones; both ways are one list of
    edges, so elements and contracts are joined once.  Elements without a valid contract and
    product lead nowhere and are left out before the links multiply the accounts; that join
    is dealt by number, as its rows are many times what it reads.
    """
    types = valid_at(contract_types, date).select("contract_type").distinct()
    products = valid_at(element_types, date).select("product").distinct()
    typed = contracts.join(types, "contract_type", "left_semi")
    members = elements.join(products, "product", "left_semi")
    leading = members.join(typed, "contract", "left_semi").select("element")
    own = accounts.select("account", "element")
    useful = links.join(leading.withColumnRenamed("element", "linked"), "linked", "left_semi")
    linked = dealt(own, "element").join(dealt(useful, "element"), "element").select("account", F.col("linked").alias("element"))
    return (
        own.join(leading, "element", "left_semi")
        .select("account", "element")
        .unionByName(linked)
        .distinct()
        .join(members, "element")
        .join(typed, "contract")
        .join(holders.where("main").select("contract", "holder"), "contract", "left")
    )
