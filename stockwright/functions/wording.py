"""Texts that results carry."""

# Reasons of refusals.
NO_QTY = "Quantity must be greater than 0"
NO_PRICE = "Price must be greater than 0"
NO_PRODUCT = "Product not found"
NO_WAREHOUSE = "Warehouse not found"
NO_INVOICE = "Purchase invoice not found"
PRODUCT_INACTIVE = "Product is not active"
WAREHOUSE_INACTIVE = "Warehouse is not active"
PRODUCT_UNUSABLE = "Product not found or not active"
WAREHOUSE_UNUSABLE = "Warehouse not found or not active"
NUMBER_TAKEN = "Invoice number is taken"
NO_STOCK = "Insufficient stock"
OVER_MAX = "Exceeds maximum stock level"
UNDER_MIN = "Sale will bring stock below minimum level"
UNDER_ZERO = "Would result in negative stock"
LINE_CLOSED = "Cannot add line to confirmed or cancelled invoice"
BUY_INACTIVE = "Cannot add inactive product to purchase"
BUY_CLOSED_SITE = "Cannot add purchase to inactive warehouse"
SELL_INACTIVE = "Cannot sell inactive product"
SELL_CLOSED_SITE = "Cannot sell from inactive warehouse"
MOVE_INACTIVE = "Cannot add movement for inactive product"
MOVE_CLOSED_SITE = "Cannot add movement to inactive warehouse"
MOVE_KIND = "Invalid movement type"
PURCHASE_FIXED = "Cannot change status of confirmed or cancelled invoice"
SUPPLIER_FIXED = "Cannot change supplier for confirmed or cancelled invoice"
SALE_FIXED = "Cannot change status of confirmed, shipped or cancelled invoice"
SALE_SHORT = "Cannot confirm invoice: insufficient stock for some products"
IS_CONFIRMED = "Invoice is already confirmed"
IS_CANCELLED = "Cannot confirm cancelled invoice"
PRICE_DROP = "Cannot reduce price by more than 20%"
MIN_NEGATIVE = "Minimum stock level cannot be negative"
MAX_TOO_LOW = "Maximum stock level must be greater than minimum stock level"
ON_DRAFT_PURCHASE = "Cannot deactivate product: it exists in draft purchase invoices"
ON_DRAFT_SALE = "Cannot deactivate product: it exists in draft sales invoices"
DELETE_CLOSED = "Cannot delete line from a document that is not a draft"

# Who closed an alert.
REPLENISHED = "Stock replenished"
DEACTIVATED = "Product deactivation"
PURCHASE_CONFIRMED = "Purchase confirmation"
RECEIVED = "Purchase"

# Parts of the notes on movements, and the name shown for no supplier.
PURCHASE_NOTE = "Purchase from "
SALE_NOTE = "Sale to customer "
INVOICE_NOTE = ", invoice "
NO_SUPPLIER = "Нет поставщика"
