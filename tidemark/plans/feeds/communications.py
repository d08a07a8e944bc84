"""The communications feed: contact details of people with a current lease or tenancy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import Instant, as_timestamp, format_twelve_hour
from tidemark.functions.decoding import decode, decode_rank
from tidemark.functions.hashing import sha1_null_skipped, zone_free_views
from tidemark.operators.membership import rows_in
from tidemark.operators.projection import active_at

# Channel codes, precedence codes, and the constants of the staging table.
CHANNEL_CODES = {
    "TELEPHONE": "ZCM-MT1",
    "EMAIL": "ZCM-UE1",
    "WORK": "ZCM-WT1",
    "HOMETEL": "ZCM-T",
    "CONTACTTEL": "ZCM-T2",
    "FAX, EBILL,FACEBOOK,TWITTER": "ZCM-O",
    "INTERNAT": "ZCM-T3",
    "LETTER": "ZCM-L",
}
OTHER_CHANNEL = "ZCM-O"
FIRST_CONTACT, LATER_CONTACT, UNKNOWN_CONTACT = "001", "002", "000"
DATA_OWNERSHIP = 21
SOURCE_SYSTEM = 21


def current_parties(
    lease_parties: DataFrame,
    lease_assignments: DataFrame,
    tenancy_instances: DataFrame,
    household_persons: DataFrame,
    tenancies: DataFrame,
    *,
    as_of: Instant,
) -> DataFrame:
    """Distinct ids of the parties to a lease assignment or a tenancy that is active at `as_of`."""
    as_of = as_timestamp(as_of)
    leases = lease_assignments.where(active_at(as_of, F.col("las_start_date"), F.col("las_end_date")))
    running = tenancies.where(active_at(as_of, F.col("tcy_act_start_date"), F.col("tcy_act_end_date")))
    lessees = rows_in(lease_parties, leases, {"lpt_las_lea_pro_refno": "las_lea_pro_refno"})
    instances = rows_in(tenancy_instances, running, {"tin_tcy_refno": "tcy_refno"})
    tenants = rows_in(household_persons, instances, {"hop_refno": "tin_hop_refno"})
    parties = lessees.select(F.col("lpt_par_refno").alias("party")).unionByName(
        tenants.select(F.col("hop_par_refno").alias("party"))
    )
    return parties.distinct()


@zone_free_views
def communications_feed(
    contact_details: DataFrame, parties: DataFrame, current: DataFrame, *, as_of: Instant, creator: str
) -> DataFrame:
    """Contacts of the `current` parties (see `current_parties`), each once.

    Being in one of two sets is one semi join with their union. It narrows the parties first, so the
    contacts take part in a single join, in which AQE can split a party with very many of them.
    """
    as_of = as_timestamp(as_of)
    wanted = rows_in(parties, current, {"par_refno": "party"})
    contacts = (
        contact_details.join(wanted, F.col("cde_par_refno") == F.col("par_refno"))
        .select(
            F.col("cde_contact_value").alias("VALUE"),
            F.col("cde_contact_name").alias("COMMUNICATION_NAME"),
            decode_rank(F.col("cde_precedence"), FIRST_CONTACT, LATER_CONTACT, UNKNOWN_CONTACT)
            .alias("DEFAULT_COMMUNICATION"),
            F.col("par_refno").alias("F_PERSON"),
            decode(F.col("cde_frv_cme_code"), CHANNEL_CODES, OTHER_CHANNEL).alias("F_COMMUNICATION_TYPE"),
            F.lit(None).cast("string").alias("OTHER_INFO"),
            F.col("cde_refno").alias("COMMUNICATION_ID"),
            F.lit("Communication").alias("B_CLASSNAME"),
            format_twelve_hour(as_of).alias("B_CREDATE"),
            F.lit(creator).alias("B_CREATOR"),
            F.lit(DATA_OWNERSHIP).alias("F_DATA_OWNERSHIP"),
            F.lit(SOURCE_SYSTEM).alias("F_SOURCE_SYSTEM"),
        )
    )
    return contacts.select("*", sha1_null_skipped(
        "VALUE", "COMMUNICATION_NAME", "DEFAULT_COMMUNICATION", "F_PERSON", "F_COMMUNICATION_TYPE", "OTHER_INFO",
        "COMMUNICATION_ID",
    ).alias("HASH_VALUE"))
