"""Schemas of the raw records and of the envelopes around them.

Reading with a given schema saves the inference pass over the files and keeps optional fields present.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The fields of the raw records.
MONEY = "struct<amount:bigint,currency:string>"

CARD = f"""struct<
  card:struct<card_brand:string,card_type:string,last_4:string,exp_month:int,exp_year:int,
    fingerprint:string,prepaid_type:string>,
  entry_method:string,status:string,avs_status:string,cvv_status:string,auth_result_code:string,
  statement_description:string,
  card_payment_timeline:struct<authorized_at:string,captured_at:string>>"""

LINE_ITEM = f"""struct<
  uid:string,catalog_object_id:string,catalog_version:bigint,name:string,variation_name:string,
  item_type:string,quantity:string,base_price_money:{MONEY},gross_sales_money:{MONEY},
  total_discount_money:{MONEY},total_tax_money:{MONEY},total_service_charge_money:{MONEY},
  total_card_surcharge_money:{MONEY},total_money:{MONEY},variation_total_price_money:{MONEY}>"""

TENDER = f"""struct<
  id:string,payment_id:string,transaction_id:string,created_at:string,type:string,amount_money:{MONEY},
  other_details:struct<source:string,status:string>,card_details:{CARD},
  cash_details:struct<buyer_tendered_money:{MONEY},change_back_money:{MONEY}>>"""

ORDER = f"""struct<
  id:string,reference_id:string,location_id:string,customer_id:string,state:string,version:bigint,
  created_at:string,updated_at:string,closed_at:string,
  total_money:{MONEY},total_tax_money:{MONEY},total_discount_money:{MONEY},total_tip_money:{MONEY},
  total_service_charge_money:{MONEY},total_card_surcharge_money:{MONEY},
  net_amounts:struct<total_money:{MONEY},tax_money:{MONEY},discount_money:{MONEY},tip_money:{MONEY},
    service_charge_money:{MONEY},card_surcharge_money:{MONEY}>,
  net_amount_due_money:{MONEY},source:struct<name:string>,
  line_items:array<{LINE_ITEM}>,tenders:array<{TENDER}>>"""

PAYMENT = f"""struct<
  id:string,order_id:string,customer_id:string,location_id:string,status:string,source_type:string,
  created_at:string,updated_at:string,receipt_number:string,receipt_url:string,version_token:string,
  delay_action:string,delay_duration:string,delayed_until:string,
  amount_money:{MONEY},total_money:{MONEY},approved_money:{MONEY},
  external_details:struct<source:string,type:string>,card_details:{CARD},
  cash_details:struct<buyer_supplied_money:{MONEY},change_back_money:{MONEY}>,
  risk_evaluation:struct<risk_level:string>,
  application_details:struct<application_id:string,product:string>,
  processing_fee:array<struct<effective_at:string,type:string,amount_money:{MONEY}>>>"""

CUSTOMER = """struct<
  id:string,reference_id:string,given_name:string,family_name:string,email_address:string,
  phone_number:string,company_name:string,note:string,created_at:string,updated_at:string,
  creation_source:string,
  address:struct<address_line_1:string,address_line_2:string,administrative_district_level_1:string,
    locality:string,postal_code:string,country:string>,
  preferences:struct<email_unsubscribed:boolean>,segment_ids:array<string>,version:bigint>"""

VARIATION_DATA = f"""struct<
  item_id:string,name:string,sku:string,ordinal:bigint,price_money:{MONEY},pricing_type:string,
  sellable:boolean,stockable:boolean>"""

CATALOG_OBJECT = f"""struct<
  type:string,id:string,created_at:string,updated_at:string,version:bigint,is_deleted:boolean,
  present_at_all_locations:boolean,
  item_data:struct<name:string,description:string,product_type:string,is_archived:boolean,
    is_taxable:boolean,categories:array<struct<id:string>>,
    variations:array<struct<id:string,item_variation_data:{VARIATION_DATA}>>>,
  item_variation_data:{VARIATION_DATA},
  category_data:struct<name:string,is_top_level:boolean,online_visibility:boolean,
    category_type:string,parent_category:struct<id:string>>>"""

INVENTORY_COUNT = """struct<
  catalog_object_id:string,catalog_object_type:string,state:string,location_id:string,
  quantity:string,calculated_at:string>"""

EMPLOYEE = """struct<
  id:string,first_name:string,last_name:string,email:string,phone_number:string,status:string,
  created_at:string,updated_at:string,location_ids:array<string>>"""

LOCATION = """struct<
  id:string,name:string,business_name:string,status:string,type:string,timezone:string,
  currency:string,language_code:string,country:string,merchant_id:string,phone_number:string,
  website_url:string,description:string,mcc:string,created_at:string,updated_at:string,
  address:struct<address_line_1:string,address_line_2:string,locality:string,
    administrative_district_level_1:string,postal_code:string,country:string>,
  coordinates:struct<latitude:double,longitude:double>,
  tax_ids:struct<eu_vat:string,us_ein:string>>"""

# Which array an envelope keeps each kind of record in.
RECORDS = {
    "orders": ORDER,
    "payments": PAYMENT,
    "customers": CUSTOMER,
    "objects": CATALOG_OBJECT,
    "counts": INVENTORY_COUNT,
    "employees": EMPLOYEE,
    "locations": LOCATION,
}

MAPPING_CSV = "BusinessMenuID string, BusinessCategoryID string, ItemID string, VariationID string"


def record_type(entity: str) -> T.DataType:
    return T.DataType.fromDDL(RECORDS[entity])


def envelope(entity: str) -> T.StructType:
    """Schema of an envelope: ingest metadata around one array of records."""
    extra = "requested_variations bigint, returned_counts bigint," if entity == "counts" else ""
    return T.StructType.fromDDL(
        "ingested_at string, source string, location_id string, record_count bigint,"
        f"{extra} {entity} array<{RECORDS[entity]}>"
    )


def narrowed(entity: str, paths: Iterable[str]) -> T.StructType:
    """Envelope schema with only the given record fields (dotted paths, or whole arrays and structs).

    Spark does not prune several fields of an exploded record by itself; reading under this schema does.
    """
    wanted = [path.split(".") for path in paths]

    def keep(struct: T.StructType, tails: list[list[str]]) -> T.StructType:
        fields = []
        for f in struct.fields:
            below = [t[1:] for t in tails if t[0] == f.name]
            if below and isinstance(f.dataType, T.StructType) and all(below):
                fields.append(T.StructField(f.name, keep(f.dataType, below)))
            elif below and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType) and all(below):
                fields.append(T.StructField(f.name, T.ArrayType(keep(f.dataType.elementType, below))))
            elif below:
                fields.append(f)
        return T.StructType(fields)

    return T.StructType(
        [
            T.StructField(f.name, T.ArrayType(keep(f.dataType.elementType, wanted))) if f.name == entity else f
            for f in envelope(entity).fields
        ]
    )
