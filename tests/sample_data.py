"""The six sample layers of the original framework, as CSV text.

Fixed values: the rows below are the sample data whose check results are the
goldens (customer: type 1 with three kept batches; orders: type 2 with an
is_active flag and an order of a customer that does not exist).
"""

CUSTOMER_SOURCE = """customer_id,first_name,last_name,email,phone_number,address,city,state,zip_code
1,John,Doe,john@example.com,1234567890,123 Main St,San Jose,CA,95123
2,Jane,Smith,jane@example.com,2345678901,456 Oak St,Fremont,CA,94536
3,Alice,Brown,alice@example.com,,789 Pine St,Sunnyvale,CA,94085
3,Bob,Green,bob@example.com,3456789012,101 Maple St,Palo Alto,CA,94301
5,Charlie,Lee,charlie@example.com,4567890123,202 Elm St,Mountain View,CA,94040
"""

CUSTOMER_STAGING = """customer_id,first_name,last_name,email,phone_number,address,city,state,zip_code,batch_date
1,John,Doe,john@example.com,1234567890,123 Main St,San Jose,CA,95123,2025-12-17
2,Jane,Smith,jane@example.com,2345678901,456 Oak St,Fremont,CA,94536,2025-12-17
3,Alice,Brown,alice@example.com,,789 Pine St,Sunnyvale,CA,94085,2025-12-17
3,Bob,Green,bob@example.com,3456789012,101 Maple St,Palo Alto,CA,94301,2025-12-17
5,Charlie,Lee,charlie@example.com,4567890123,202 Elm St,Mountain View,CA,94040,2025-12-17
"""

CUSTOMER_TARGET = """customer_id,first_name,last_name,email,phone_number,address,city,state,zip_code,batch_date
1,John,Doe,john@example.com,1234567890,123 Main St,San Jose,CA,95123,2025-12-15
2,Jane,Smith,jane.smith@example.com,2345678901,456 Oak St,Fremont,CA,94536,2025-12-15
3,Alice,Brown,alice@example.com,,789 Pine St,Sunnyvale,CA,94085,2025-12-15
3,Bob,Green,bob@example.com,3456789012,101 Maple St,Palo Alto,CA,94301,2025-12-15
5,Charlie,Lee,charlie@example.com,4560000000,202 Elm St,Mountain View,CA,94040,2025-12-15
1,John,Doe,john.new@example.com,1234567890,123 Main St,San Jose,CA,95123,2025-12-16
2,Jane,Smith,jane@example.com,2345678901,456 Oak St,Fremont,CA,94536,2025-12-16
3,Alice,Brown,alice@example.com,,789 Pine St,Sunnyvale,CA,94085,2025-12-16
3,Bob,Green,bob@example.com,3456789012,101 Maple St,Palo Alto,CA,94301,2025-12-16
5,Charlie,Lee,charlie@example.com,4567890123,202 Elm St,Mountain View,CA,94040,2025-12-16
1,John,Doe,john@example.com,1234567890,123 Main St,San Jose,CA,95123,2025-12-17
2,Jane,Smith,jane@example.com,2345678901,456 Oak St,Fremont,CA,94536,2025-12-17
3,Alice,Brown,alice@example.com,,789 Pine St,Sunnyvale,CA,94085,2025-12-17
3,Bob,Green,bob@example.com,3456789012,101 Maple St,Palo Alto,CA,94301,2025-12-17
5,Charlie,Lee,charlie@example.com,4567890123,202 Elm St,Mountain View,CA,94040,2025-12-17
"""

ORDERS_SOURCE = """order_id,customer_id,order_date,amount
101,1,2025-08-20,250
102,2,2025-08-21,450
103,3,2025-08-22,300
104,4,2025-08-23,500
105,5,2025-08-24,600
"""

ORDERS_STAGING = """order_id,customer_id,order_date,amount,batch_date
101,1,2025-08-20,250,2025-12-17
102,2,2025-08-21,450,2025-12-17
103,3,2025-08-22,300,2025-12-17
104,4,2025-08-23,500,2025-12-17
105,5,2025-08-24,600,2025-12-17
"""

ORDERS_TARGET = """order_id,customer_id,order_date,amount,batch_date,effective_start_date,effective_end_date,is_active
101,1,2025-08-20,250,2025-12-17,2025-12-15,,Y
102,2,2025-08-21,450,2025-12-17,2025-12-15,,Y
103,3,2025-08-22,300,2025-12-17,2025-12-15,2025-12-15,N
104,4,2025-08-23,500,2025-12-17,2025-12-15,,Y
105,5,2025-08-24,600,2025-12-17,2025-12-15,,Y
101,1,2025-08-20,250,2025-12-17,2025-12-16,,Y
102,2,2025-08-21,450,2025-12-17,2025-12-16,,Y
103,3,2025-08-22,310,2025-12-17,2025-12-16,,Y
104,4,2025-08-23,500,2025-12-17,2025-12-16,,Y
105,5,2025-08-24,600,2025-12-17,2025-12-16,2025-12-16,N
101,1,2025-08-20,250,2025-12-17,2025-12-17,,Y
102,2,2025-08-21,450,2025-12-17,2025-12-17,,Y
103,3,2025-08-22,300,2025-12-17,2025-12-17,,Y
104,4,2025-08-23,500,2025-12-17,2025-12-17,,Y
105,5,2025-08-24,620,2025-12-17,2025-12-17,,Y
"""

SCHEMA_CONFIG = {
    "customer_data": {
        "staging": [
            {"name": "customer_id", "type": "IntegerType", "nullable": False},
            {"name": "first_name", "type": "StringType", "nullable": True},
            {"name": "last_name", "type": "StringType", "nullable": True},
            {"name": "email", "type": "StringType", "nullable": True},
            {"name": "phone_number", "type": "StringType", "nullable": True},
            {"name": "address", "type": "StringType", "nullable": True},
            {"name": "city", "type": "StringType", "nullable": True},
            {"name": "state", "type": "StringType", "nullable": True},
            {"name": "zip_code", "type": "IntegerType", "nullable": True},
            {"name": "batch_date", "type": "StringType", "nullable": False},
        ],
        "target": [
            {"name": "customer_id", "type": "IntegerType", "nullable": False},
            {"name": "first_name", "type": "StringType", "nullable": True},
            {"name": "last_name", "type": "StringType", "nullable": True},
            {"name": "email", "type": "StringType", "nullable": True},
            {"name": "phone_number", "type": "StringType", "nullable": True},
            {"name": "address", "type": "StringType", "nullable": True},
            {"name": "city", "type": "StringType", "nullable": True},
            {"name": "state", "type": "StringType", "nullable": True},
            {"name": "zip_code", "type": "IntegerType", "nullable": True},
            {"name": "batch_date", "type": "StringType", "nullable": False},
        ],
    },
    "orders_data": {
        "staging": [
            {"name": "order_id", "type": "IntegerType", "nullable": False},
            {"name": "customer_id", "type": "IntegerType", "nullable": False},
            {"name": "order_date", "type": "StringType", "nullable": True},
            {"name": "amount", "type": "FloatType", "nullable": True},
            {"name": "batch_date", "type": "StringType", "nullable": False},
        ],
        "target": [
            {"name": "order_id", "type": "IntegerType", "nullable": False},
            {"name": "customer_id", "type": "IntegerType", "nullable": False},
            {"name": "order_date", "type": "StringType", "nullable": True},
            {"name": "amount", "type": "FloatType", "nullable": True},
            {"name": "effective_start_date", "type": "StringType", "nullable": False},
            {"name": "effective_end_date", "type": "StringType", "nullable": True},
            {"name": "is_active", "type": "StringType", "nullable": False},
        ],
    },
}


def write_fixture(folder) -> dict:
    """Write the six CSVs into ``folder`` and return a file config pointing at them."""
    files = {
        "customers/source.csv": CUSTOMER_SOURCE,
        "customers/staging.csv": CUSTOMER_STAGING,
        "customers/target.csv": CUSTOMER_TARGET,
        "orders/source.csv": ORDERS_SOURCE,
        "orders/staging.csv": ORDERS_STAGING,
        "orders/target.csv": ORDERS_TARGET,
    }
    for name, text in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)
    p = lambda n: str(folder / n)
    return {
        "customer_data": {
            "src_file_path": p("customers/source.csv"),
            "stg_file_path": p("customers/staging.csv"),
            "trgt_file_path": p("customers/target.csv"),
            "primary_key": ["customer_id"],
            "non_nullable_columns": ["customer_id", "batch_date"],
            "scd_type": "type1",
        },
        "orders_data": {
            "src_file_path": p("orders/source.csv"),
            "stg_file_path": p("orders/staging.csv"),
            "trgt_file_path": p("orders/target.csv"),
            "primary_key": ["order_id"],
            "non_nullable": {
                "source_to_staging": ["order_id", "customer_id"],
                "staging_to_target": ["order_id", "customer_id", "is_active"],
            },
            "scd_type": "type2",
            "active_flag_column": "is_active",
            "lookup": {"lookup_file": "customer_data", "lookup_column": "customer_id", "target_column": "customer_id"},
        },
    }
