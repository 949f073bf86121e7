"""Column roles, fixed labels and tunables of the campaign data model.

Everything an operator needs to know about the customer table lives in one
``CampaignSchema`` object so that operators stay generic DataFrame → DataFrame
transforms and tests can swap thresholds without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Column names, category labels, orders and thresholds, stated in natural order.
# --------------------------------------------------------------------------
GROUP_COLUMNS = ["Marital_Status", "Education"]
EXCLUDED_RAW_COLUMNS = ["Z_CostContact", "Z_Revenue"]
DERIVED_COLUMNS = ["Age", "Total_Spent", "Highest_Spent", "Total_Purchases"]
BINARY_COLUMNS = [
    "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "AcceptedCmp1", "AcceptedCmp2",
    "Complain", "Response",
]
DISCRETE_EMPIRICAL_COLUMNS = ["Kidhome", "Teenhome"]
INTEGER_NOISE_COLUMNS = [
    "Recency",
    "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
    "MntGoldProds",
    "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
    "NumWebVisitsMonth",
]
FLOAT_NOISE_COLUMNS = ["Income"]
PRODUCT_COLUMNS = [
    "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
    "MntGoldProds",
]
CHANNEL_COLUMNS = {
    "NumDealsPurchases": "Deals",
    "NumWebPurchases": "Web",
    "NumCatalogPurchases": "Catalog",
    "NumStorePurchases": "Store",
}
CAMPAIGN_COLUMNS = [
    "AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "Response",
]
CAMPAIGN_LABELS = ["Cmp1", "Cmp2", "Cmp3", "Cmp4", "Cmp5", "Last (Response)"]
SEGMENT_ORDER = ["Inactive", "Occasional", "Moderate", "Loyal", "Premium"]
MARITAL_NOISE = ["Alone", "Absurd", "YOLO"]
MARITAL_NOISE_TARGET = "Single"
EDUCATION_VALUES = ["2n Cycle", "Basic", "Graduation", "Master", "PhD"]
MARITAL_VALUES = ["Divorced", "Married", "Single", "Together", "Widow"]
# RMF_Score lower bounds of each segment, in SEGMENT_ORDER.
SEGMENT_LOWER_BOUNDS = [0, 1, 3, 5, 7]
# Radar features of the customer lookup; Recency is inverted.
RADAR_FEATURES = ["Recency", "Total_Purchases", "Total_Spent", "Income", "APV", "Campaigns_Accepted"]
TOP_DECILE_FEATURES = ["Income", "Age", "Total_Spent", "Total_Purchases", "NumWebVisitsMonth", "Recency"]
METRIC_COMPARISON_COLUMNS = [
    "Income", "Recency", "MntWines", "MntMeatProducts", "NumWebPurchases", "NumStorePurchases",
    "Response",
]
# Measures of the grouped mean / std tables, in table order.
GROUP_MEASURES = [
    "Income", "Kidhome", "Teenhome", "Recency", "Complain",
    "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
    "MntGoldProds",
    "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
    "NumWebVisitsMonth",
    "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "AcceptedCmp1", "AcceptedCmp2", "Response",
    "Total_Spent", "Age", "Total_Purchases",
]
# Grouped measures kept as money (2 dp) rather than rounded to whole counts.
MONEY_MEASURES = ["Income", "Total_Spent"] + PRODUCT_COLUMNS
# Raw table column order (27 warehouse columns + the two constants before Response).
RAW_COLUMNS = [
    "ID", "Year_Birth", "Education", "Marital_Status", "Income", "Kidhome", "Teenhome",
    "Dt_Customer", "Recency",
    "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
    "MntGoldProds",
    "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
    "NumWebVisitsMonth",
    "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "AcceptedCmp1", "AcceptedCmp2",
    "Complain", "Z_CostContact", "Z_Revenue", "Response",
]
# Column descriptions shown by the data dictionary.
DATA_DICTIONARY = {
    "ID": "Customer's unique identifier",
    "Year_Birth": "Customer's birth year",
    "Education": "Customer's education level",
    "Marital_Status": "Customer's marital status",
    "Income": "Customer's yearly household income",
    "Kidhome": "Number of children in customer's household",
    "Teenhome": "Number of teenagers in customer's household",
    "Dt_Customer": "Date of customer's enrollment with the company",
    "Recency": "Number of days since customer's last purchase",
    "Complain": "1 if the customer complained in the last 2 years, 0 otherwise",
    "MntWines": "Amount spent on wine in last 2 years",
    "MntFruits": "Amount spent on fruits in last 2 years",
    "MntMeatProducts": "Amount spent on meat in last 2 years",
    "MntFishProducts": "Amount spent on fish in last 2 years",
    "MntSweetProducts": "Amount spent on sweets in last 2 years",
    "MntGoldProds": "Amount spent on gold in last 2 years",
    "NumDealsPurchases": "Number of purchases made with a discount",
    "AcceptedCmp1": "1 if customer accepted the offer in the 1st campaign, 0 otherwise",
    "AcceptedCmp2": "1 if customer accepted the offer in the 2nd campaign, 0 otherwise",
    "AcceptedCmp3": "1 if customer accepted the offer in the 3rd campaign, 0 otherwise",
    "AcceptedCmp4": "1 if customer accepted the offer in the 4th campaign, 0 otherwise",
    "AcceptedCmp5": "1 if customer accepted the offer in the 5th campaign, 0 otherwise",
    "Response": "1 if customer accepted the offer in the last campaign, 0 otherwise",
    "NumWebPurchases": "Number of purchases made through the company’s website",
    "NumCatalogPurchases": "Number of purchases made using a catalogue",
    "NumStorePurchases": "Number of purchases made directly in stores",
    "NumWebVisitsMonth": "Number of visits to company’s website in the last month",
}
# Segment personas and action playbook.
PERSONAS = {
    "Premium": (
        "Recent, frequent, high-spend customers — your VIPs. Retention and "
        "reward programs are the priority."
    ),
    "Loyal": (
        "Frequent buyers with strong engagement, slightly below Premium spend. "
        "Upsell and cross-sell opportunities."
    ),
    "Moderate": (
        "Mid-tier across all RFM dimensions. The largest segment — biggest "
        "activation opportunity."
    ),
    "Occasional": (
        "Light buyers across all RFM dimensions — one step above Inactive. "
        "Reactivation and onboarding campaigns are the priority."
    ),
    "Inactive": (
        "Disengaged across all RFM dimensions. Win-back campaigns or "
        "churn-reason surveys."
    ),
}
ACTIONS = {
    "Premium": [
        "VIP perks: early access, exclusive products, dedicated account management",
        "Loyalty rewards tied to spend tier",
        "Cross-sell premium product lines",
        "Personalized concierge campaigns",
    ],
    "Loyal": [
        "Subscription or auto-replenishment programs",
        "Referral rewards (high engagement = good ambassadors)",
        "Targeted upsell into premium products",
        "Bundle offers to increase basket size",
    ],
    "Moderate": [
        "Surprise/delight campaigns to nudge into Loyal",
        "Targeted offers based on Highest_Spent category",
        "Email series to increase frequency",
        "Free shipping thresholds to lift basket size",
    ],
    "Occasional": [
        "Reactivation campaigns with low-friction first-step offers",
        "Onboarding email series for newer customers",
        "Repeat-purchase incentives (free shipping, second-purchase discount)",
        "Retargeting based on first-purchase category",
    ],
    "Inactive": [
        "Win-back campaigns with deep discounts",
        "Survey to understand churn reasons",
        "Re-engagement email series with curated content",
        "If unresponsive after 90 days, deprioritize from active marketing spend",
    ],
}
# Search grid of the clustering parameter search.
SEARCH_GRID = {
    "n_clusters": [2, 3, 4],
    "init": ["k-means++", "random"],
    "n_init": [10, 20, 30, 40, 50],
    "max_iter": [300, 500, 700, 100],
}
SEARCH_SEED = 1234
# --------------------------------------------------------------------------


def product_label(column: str) -> str:
    """``MntMeatProducts`` → ``Meat``: strip Mnt, then Products, then Prods."""
    return column.replace("Mnt", "").replace("Products", "").replace("Prods", "")


@dataclass(frozen=True)
class CampaignSchema:
    """Tunables of the pipeline; defaults follow the reference."""

    reference_year: int = 2026
    age_outlier_threshold: int = 120
    min_group_size: int = 10
    rfm_k: int = 4
    # The clustering runs until no centre changes; beyond this it raises.
    rfm_max_rounds: int = 100_000
    synthetic_seed: int = 42
    # Generator parameters pass through the driver as a table of groups; more
    # groups than this raise an error.
    broadcast_row_limit: int = 100_000
    rfm_components: tuple[tuple[str, str, bool], ...] = field(
        default=(
            # (value column, cluster column, higher value = better)
            ("Total_Purchases", "Cluster_Frequency", True),
            ("Total_Spent", "Cluster_Monetary", True),
            ("Recency", "Cluster_Recency", False),
        )
    )


DEFAULT = CampaignSchema()
