"""Fixed values of the domain, written out apart from the code they judge."""

from __future__ import annotations

GENDERS = {
    "MALE": ("M", "MALE", "MASCULINO", "HOMBRE"),
    "FEMALE": ("F", "FEMALE", "FEMENINO", "MUJER"),
    "NON_BINARY": ("NON_BINARY", "NO BINARIO", "NB"),
}
MARITAL_STATUSES = {
    "MARRIED": ("MARRIED", "CASADO", "CASADA"),
    "SINGLE": ("SINGLE", "SOLTERO", "SOLTERA"),
    "DIVORCED": ("DIVORCED", "DIVORCIADO", "DIVORCIADA"),
    "WIDOWED": ("WIDOWED", "VIUDO", "VIUDA"),
}
PAYMENT_STATUSES = {
    "COMPLETED": ("COMPLETED", "PAID", "SUCCESS", "SUCCEEDED"),
    "FAILED": ("FAILED", "DECLINED", "REJECTED"),
    "PARTIAL": ("PARTIAL", "PARTIALLY_PAID"),
    "PENDING": ("PENDING", "PROCESSING"),
}
SUBSCRIPTION_STATUSES = {
    "ACTIVE": ("ACTIVE", "ACTIVO", "ENABLED"),
    "CANCELLED": ("CANCELLED", "CANCELED", "INACTIVE", "BAJA"),
    "SUPERSEDED": ("SUPERSEDED", "REPLACED"),
}
CONTRACT_TYPES = {
    "MONTH_TO_MONTH": ("MONTH-TO-MONTH", "MONTH TO MONTH", "MENSUAL"),
    "ONE_YEAR": ("ONE YEAR", "1 YEAR", "ANNUAL"),
    "TWO_YEAR": ("TWO YEAR", "2 YEAR", "BIENNIAL"),
}
SERVICES = {
    "phone_service": "has_phone_service",
    "multiple_lines": "has_multiple_lines",
    "internet_service": "has_internet_service",
    "online_security": "has_online_security",
    "online_backup": "has_online_backup",
    "device_protection": "has_device_protection",
    "tech_support": "has_tech_support",
    "streaming_tv": "has_streaming_tv",
    "streaming_movies": "has_streaming_movies",
    "paperless_billing": "paperless_billing",
}
TICKET_STATUSES = {
    "CLOSED": ("CLOSED", "CERRADO"),
    "RESOLVED": ("RESOLVED", "RESUELTO"),
    "OPEN": ("OPEN", "ABIERTO"),
    "PENDING": ("PENDING", "PENDIENTE"),
}
ORDERS = {
    "o_orderkey": "order_key",
    "o_custkey": "customer_key",
    "o_orderstatus": "status_code",
    "o_totalprice": "total_price",
    "o_orderdate": "order_date",
}
LINEITEM = {
    "l_orderkey": "order_key",
    "l_partkey": "part_key",
    "l_quantity": "quantity",
    "l_linenumber": "line_number",
    "l_extendedprice": "extended_price",
    "l_discount": "discount_percentage",
    "l_tax": "tax_rate",
}
