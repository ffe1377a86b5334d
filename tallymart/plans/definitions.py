"""The two metric views of the retail model."""

from ..functions.columns import ratio
from .metrics import Dimension, JoinSpec, Measure, MetricView, counted, distinct, total

SALES = MetricView(
    name="sales_metrics",
    source="fact_transaction",
    comment="Sales measures, each defined once.",
    joins=[
        JoinSpec("guest", "dim_guest", "source.guest_key = guest.guest_key"),
        JoinSpec("product", "dim_product", "source.product_key = product.product_key"),
        JoinSpec("store", "dim_store", "source.store_key = store.store_key"),
    ],
    dimensions=[
        Dimension("Transaction Date", "source.transaction_date", "Day of the sale."),
        Dimension("Product Category", "product.category", "First level of the merchandise tree."),
        Dimension("Product Subcategory", "product.subcategory"),
        Dimension("Store Region", "store.region", "First level of store geography."),
        Dimension("Store District", "store.district"),
    ],
    measures=[
        Measure("Net Sales", {"net": total("source.net_amount")},
                comment="Sales after discounts and before tax."),
        Measure("Units Sold", {"units": total("source.quantity")}),
        Measure("Transaction Count", {"baskets": distinct("source.transaction_id")},
                comment="Different baskets, not lines."),
        Measure("Average Order Value",
                {"net": total("source.net_amount"), "baskets": distinct("source.transaction_id")},
                lambda net, baskets: ratio(net, baskets),
                comment="Net sales per basket."),
        Measure("Guest Count", {"guests": distinct("source.guest_key")},
                comment="Different guests who bought something."),
    ],
)

INVENTORY = MetricView(
    name="inventory_metrics",
    source="fact_inventory",
    fold=True,
    comment="Stock measures. Sales enter at the same store, product and day as the stock row.",
    joins=[
        JoinSpec("product", "dim_product", "source.product_key = product.product_key"),
        JoinSpec("store", "dim_store", "source.store_key = store.store_key"),
        JoinSpec("sales", "daily_sales_by_product_store",
                 "source.store_key = sales.store_key AND source.product_key = sales.product_key"
                 " AND source.snapshot_date = sales.sale_date",
                 range_on=("snapshot_date", "sale_date")),
    ],
    dimensions=[
        Dimension("Snapshot Date", "source.snapshot_date"),
        Dimension("Product Category", "product.category"),
        Dimension("Store Region", "store.region"),
    ],
    measures=[
        Measure("Units On Hand", {"stock": total("source.quantity_on_hand")},
                comment="Stock summed over the snapshots in scope; several days add up."),
        Measure("Units Sold", {"sold": total("sales.units_sold")},
                comment="Units sold at the store, product and day of a snapshot; NULL when none match."),
        Measure("Sell-Through Rate",
                {"sold": total("sales.units_sold"), "stock": total("source.quantity_on_hand")},
                lambda sold, stock: ratio(sold, sold + stock),
                comment="Units sold over units sold plus units on hand; an approximation."),
        Measure("Inventory Turnover",
                {"sold": total("sales.units_sold"), "stock": total("source.quantity_on_hand"),
                 "rows": counted("source.quantity_on_hand")},
                lambda sold, stock, rows: ratio(sold, ratio(stock, rows)),
                comment="Units sold over mean units on hand; not based on cost."),
    ],
)

VIEWS = {v.name: v for v in (SALES, INVENTORY)}
