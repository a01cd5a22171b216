"""Report pipelines, data-quality checks, job registry and the checked-query registry.

work_orders (J01 J02 J04), equipment (J03), purchasing (J05 J12 J13 V1 V4),
yard (J06 J07 J08 J09 V3), receipts (J14 V2), parts (J15), reservations (J10),
quality (data-quality checks), operator_queries, jobs, registry, params.
"""
