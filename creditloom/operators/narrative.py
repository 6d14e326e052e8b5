"""Explanation texts for every client at once.

Numbers print with a fixed count of decimals, rounded half-even on the exact binary value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed(value: Column, decimals: int = 2) -> Column:
    """Plain decimal text; the thousands commas of format_number go."""
    return F.regexp_replace(F.format_number(value, decimals), ",", "")


def general(value: Column) -> Column:
    """At most three decimals, without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(fixed(value, 3), "0+$", ""), r"\.$", "")


# Sentences, with slots in order.
SAFE = "Le crédit est accordé pour le client %s.\nLe risque d'insolvabilité du client est de %s, ce risque est tolérable pour la banque qui accepte jusqu'à %s de risque."
RISK = "Le crédit est refusé pour le client %s.\nLe risque d'insolvabilité du client est de %s, ce risque est supérieur au risque que la banque peut tolérer (%s)."
INFLUENCE_HEAD = "Les %s caractéristiques qui impactent le plus la décision pour le client sont :\n"
INFLUENCE_LINE = "%s\tInfluence (%s) vers %s du prêt\n"
INFLUENCE_TAIL = "\nLa valeur de base (sans connaissance du client) est de %s\nLa prédiction du risque d'insolvabilité pour ce client (connaissant ses informations) est de %s."
MEAN_BELOW = "La valeur de %s pour le client %s (%s) est inférieure à la moyenne (%s)."
MEAN_ABOVE = "La valeur de %s pour le client %s (%s) est supérieure à la moyenne (%s)."
MEAN_UNKNOWN = "La valeur de %s pour le client %s est inconnue."
BOX_HEAD = "Le client %s appartient à la catégorie %s de %s.\nAu sein de cette catégorie :\n\tla médiane de %s est de %s.\n"
BOX_ABOVE = "\tLe client %s se situe en dessus de la médiane (%s = %s).\n"
BOX_BELOW = "\tLe client %s se situe au dessous de la médiane (%s = %s).\n"
BOX_OUTLIER = "\tLe client %s est atypique par rapport à la population pour la caractérisitique %s."
BOX_TYPICAL = "\tLe client %s n'est pas atypique par rapport à la population pour la caractérisitique %s."
BOX_NO_CATEGORY = "La catégorie du client %s est inconnue pour la caractéristique %s.La valeur de %s = %s"
BOX_NO_VALUE = "La valeur de %s est inconnue pour le client %s."
BOX_NEITHER = "Les valeurs de %s et de %s sont inconnues pour le client %s."


def decision_text(client: Column, proba: Column, threshold: Column) -> Column:
    """Granted or refused, with the risk and the tolerated risk."""
    args = (client.cast("string"), fixed(proba), fixed(threshold))
    return F.when(proba > threshold, F.format_string(RISK, *args)).otherwise(F.format_string(SAFE, *args))


def influence_text(listed: Column, k: int, base: Column, proba: Column) -> Column:
    """The k strongest contributions of an array ordered by size (see explain.contribution_list)."""
    lines = F.transform(F.slice(listed, 1, k), lambda c: F.format_string(
        INFLUENCE_LINE, c["feature"], fixed(c["contribution"]), F.when(c["contribution"] > 0, "le REFUS").otherwise("l'ACCORD")))
    count = F.least(F.size(listed), F.lit(k)).cast("string")
    return F.concat(F.format_string(INFLUENCE_HEAD, count), F.array_join(lines, ""),
                    F.format_string(INFLUENCE_TAIL, fixed(base, 3), fixed(proba, 3)))


def mean_text(feature: str, client: Column, value: Column, mean: Column) -> Column:
    """Below or above the population mean."""
    args = (F.lit(feature), client.cast("string"), fixed(value), fixed(mean))
    return F.when(value.isNull(), F.format_string(MEAN_UNKNOWN, *args[:2])) \
        .when(value <= mean, F.format_string(MEAN_BELOW, *args)).otherwise(F.format_string(MEAN_ABOVE, *args))


def box_text(feature: str, category: str, client: Column, value: Column, group: Column, median: Column,
             is_outlier: Column) -> Column:
    """Place of a client inside the box of its category; states what is unknown otherwise."""
    who, f, g, v = client.cast("string"), F.lit(feature), F.lit(category), fixed(value)
    place = F.when(value > median, F.format_string(BOX_ABOVE, who, f, v)).otherwise(F.format_string(BOX_BELOW, who, f, v))
    verdict = F.when(is_outlier == 1, F.format_string(BOX_OUTLIER, who, f)).otherwise(F.format_string(BOX_TYPICAL, who, f))
    full = F.concat(F.format_string(BOX_HEAD, who, group.cast("string"), g, f, fixed(median)), place, verdict)
    return F.when(value.isNotNull() & group.isNotNull(), full) \
        .when(value.isNotNull(), F.format_string(BOX_NO_CATEGORY, who, g, f, v)) \
        .when(group.isNotNull(), F.format_string(BOX_NO_VALUE, f, who)) \
        .otherwise(F.format_string(BOX_NEITHER, f, g, who))


def reading_guide(client: Column, base: Column, proba: Column, feature: Column, value: Column, contribution: Column) -> Column:
    """How to read a contribution chart, for a reader without statistics: base risk, predicted risk,
    the strongest feature with its value, and the way it moved the risk."""
    known = F.when(value.isNull(), F.format_string("Le client ne donne aucune valeur pour %s.", feature)) \
        .otherwise(F.format_string("Le client a pour %s la valeur %s.", feature, general(value)))
    moved = F.when(contribution > 0, F.format_string("Elle augmente son risque de %s et pousse vers un refus.", fixed(contribution))) \
        .otherwise(F.format_string("Elle change son risque de %s et pousse vers un accord.", fixed(contribution)))
    return F.concat_ws(
        " ", F.format_string("Sans rien savoir du client %s, le risque moyen E[f(X)] vaut %s.", client.cast("string"), fixed(base, 3)),
        F.format_string("Connaissant ses informations, le modèle prédit f(x)=%s.", general(proba)), known, moved,
        F.lit("La valeur de base plus toutes les influences donne le risque prédit."))


def gauge_guide(proba: Column, threshold: Column) -> Column:
    """What the probability and the decision threshold mean."""
    return F.format_string(
        "Le risque est la probabilité de non-remboursement : %s, soit %s%% de chances. "
        "La banque accorde le prêt jusqu'à %s et le refuse au-delà ; ce seuil est choisi pour perdre le moins d'argent possible.",
        fixed(proba), fixed(proba * 100, 0), fixed(threshold))


def decision_texts(scored: DataFrame, threshold: float, key: str = "SK_ID_CURR", proba: str = "PROBA") -> DataFrame:
    """(key, text) for every scored client, in one projection."""
    return scored.select(key, decision_text(F.col(key), F.col(proba), F.lit(threshold)).alias("text"))
