"""Business rules passed to every builder as one frozen value.

Two rule sets ship: ``SHIPPED_RULES`` (the warehouse's production rules) and
``FIXTURE_RULES`` (rules that separate the synthetic test customers into all
five segments; see FIXTURES.md section 4).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Rules:
    new_max_orders: int = 1
    returning_max_orders: int = 5
    vip_min_orders: int = 6
    vip_min_value: float = 5000.0
    lifespan_days: int = 365
    late_threshold_days: int = 0
    very_late_threshold_days: int = 7
    calendar_start: dt.date = dt.date(2016, 9, 1)
    calendar_end: dt.date = dt.date(2018, 10, 31)
    # group -> members, first listed group wins for a member listed twice
    regions: tuple = ()
    holidays: tuple = ()
    translations: tuple = ()          # (source category, english category)
    category_segments: tuple = ()     # (segment, (category, ...))
    payment_categories: tuple = ()    # (payment type, category)
    price_outlier_quantile: float = 0.99
    delivery_outlier_days: int = 90
    extra: dict = field(default_factory=dict, compare=False)

    def with_(self, **kw) -> "Rules":
        return replace(self, **kw)


# ---------------------------------------------------------------------------
# FIXED VALUES.  These must equal the production rule set for results to
# match: segmentation thresholds, state -> region lists, the holiday list,
# the category translation table, the category segment lists and the payment
# categories.  Kept in their natural order; order matters where a member is
# listed twice (first group wins).
# ---------------------------------------------------------------------------
SHIPPED_REGIONS = (
    ("Southeast", ("SP", "RJ", "MG", "ES")),
    ("South", ("PR", "SC", "RS")),
    ("Northeast", ("BA", "CE", "PE", "RN", "PB", "AL", "SE", "MA", "PI")),
    ("North", ("AM", "PA", "AC", "RO", "RR", "AP", "TO")),
    ("Central-West", ("GO", "MT", "MS", "DF")),
)

SHIPPED_HOLIDAYS = (
    "2016-01-01", "2016-02-08", "2016-02-09", "2016-03-25",
    "2016-04-21", "2016-05-01", "2016-09-07", "2016-10-12",
    "2016-11-02", "2016-11-15", "2016-12-25",
    "2017-01-01", "2017-02-27", "2017-02-28", "2017-04-14",
    "2017-04-21", "2017-05-01", "2017-09-07", "2017-10-12",
    "2017-11-02", "2017-11-15", "2017-12-25",
    "2018-01-01", "2018-02-12", "2018-02-13", "2018-03-30",
    "2018-04-21", "2018-05-01", "2018-09-07", "2018-10-12",
    "2018-11-02", "2018-11-15", "2018-12-25",
)

SHIPPED_TRANSLATIONS = (
    ("beleza_saude", "health_beauty"),
    ("informatica_acessorios", "computers_accessories"),
    ("automotivo", "automotive"),
    ("cama_mesa_banho", "bed_bath_table"),
    ("moveis_decoracao", "furniture_decor"),
    ("esporte_lazer", "sports_leisure"),
    ("perfumaria", "perfumery"),
    ("utilidades_domesticas", "housewares"),
    ("telefonia", "telephony"),
    ("relogios_presentes", "watches_gifts"),
    ("alimentos_bebidas", "food_drinks"),
    ("bebes", "baby"),
    ("papelaria", "stationery"),
    ("tablets_impressao_imagem", "tablets_printing_image"),
    ("brinquedos", "toys"),
    ("telefonia_fixa", "fixed_telephony"),
    ("ferramentas_jardim", "garden_tools"),
    ("fashion_bolsas_e_acessorios", "fashion_bags_accessories"),
    ("eletrônicos", "electronics"),
    ("eletrodomesticos", "home_appliances"),
    ("livros_interesse_geral", "books_general_interest"),
    ("construcao_ferramentas_construcao", "construction_tools_construction"),
    ("casa_construcao", "home_construction"),
    ("instrumentos_musicais", "musical_instruments"),
    ("eletrodomesticos_2", "home_appliances_2"),
    ("livros_tecnicos", "books_technical"),
    ("cool_stuff", "cool_stuff"),
    ("malas_acessorios", "luggage_accessories"),
    ("climatizacao", "air_conditioning"),
    ("construcao_ferramentas_iluminacao", "construction_tools_lighting"),
    ("artigos_de_festas", "party_supplies"),
    ("construcao_ferramentas_seguranca", "construction_tools_safety"),
    ("industria_comercio_e_negocios", "industry_commerce_business"),
    ("livros_importados", "books_imported"),
    ("pcs", "computers"),
    ("artigos_de_natal", "christmas_articles"),
    ("fashion_calcados", "fashion_shoes"),
    ("flores", "flowers"),
    ("artes_e_artesanato", "arts_crafts"),
    ("fraldas_higiene", "diapers_hygiene"),
    ("fashion_underwear_e_moda_praia", "fashion_underwear_beach"),
    ("pet_shop", "pet_shop"),
    ("moveis_sala", "living_room_furniture"),
    ("construcao_ferramentas_jardim", "construction_tools_garden"),
    ("fashion_esporte", "fashion_sports"),
    ("sinalizacao_e_seguranca", "signaling_security"),
    ("la_cuisine", "la_cuisine"),
    ("dvds_blu_ray", "dvds_blu_ray"),
    ("fashion_roupa_masculina", "fashion_male_clothing"),
    ("portateis_casa_forno_e_cafe", "portable_kitchen_food_processor"),
    ("cds_dvds_musicais", "cds_dvds_musicals"),
    ("consoles_games", "consoles_games"),
    ("audio", "audio"),
    ("fashion_roupa_feminina", "fashion_female_clothing"),
    ("seguros_e_servicos", "insurance_services"),
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen"),
    ("casa_conforto_2", "home_comfort_2"),
    ("agro_industria_e_comercio", "agro_industry_commerce"),
    ("market_place", "market_place"),
    ("fashion_roupa_infanto_juvenil", "fashion_children_clothes"),
    ("musica", "music"),
    ("casa_conforto", "home_comfort"),
    ("cine_foto", "cine_photo"),
    ("moveis_cozinha_area_de_servico_jantar_e_jardim", "kitchen_dining_laundry_garden_furniture"),
    ("moveis_escritorio", "office_furniture"),
    ("moveis_quarto", "bedroom_furniture"),
    ("fashion_roupa_de_banho", "fashion_swimwear"),
    ("alimentos", "food"),
    ("artes", "arts"),
    ("eletronicos", "electronics"),
    ("livros", "books"),
)

SHIPPED_CATEGORY_SEGMENTS = (
    ("Electronics", (
        "computers_accessories", "telephony", "electronics",
        "tablets_printing_image", "fixed_telephony", "computers",
        "consoles_games", "audio", "cine_photo")),
    ("Home & Furniture", (
        "bed_bath_table", "furniture_decor", "housewares",
        "home_appliances", "home_construction", "air_conditioning",
        "living_room_furniture", "kitchen_dining_laundry_garden_furniture",
        "office_furniture", "bedroom_furniture", "home_comfort",
        "home_appliances_2", "home_comfort_2", "la_cuisine")),
    ("Fashion & Beauty", (
        "health_beauty", "perfumery", "fashion_bags_accessories",
        "fashion_shoes", "fashion_underwear_beach", "fashion_sports",
        "fashion_male_clothing", "fashion_female_clothing",
        "fashion_children_clothes", "fashion_swimwear", "watches_gifts")),
    ("Sports & Leisure", (
        "sports_leisure", "toys", "baby", "pet_shop", "diapers_hygiene")),
    ("Books & Media", (
        "books_general_interest", "books_technical", "books_imported",
        "dvds_blu_ray", "cds_dvds_musicals", "music", "stationery",
        "arts_crafts", "arts")),
    ("Automotive & Tools", (
        "automotive", "garden_tools", "construction_tools_construction",
        "construction_tools_lighting", "construction_tools_safety",
        "construction_tools_garden", "signaling_security")),
    ("Food & Drinks", (
        "food_drinks", "food", "portable_kitchen_food_processor",
        "portable_kitchen")),
    ("Gifts & Party", (
        "party_supplies", "christmas_articles", "flowers", "cool_stuff")),
    ("Business & Industry", (
        "industry_commerce_business", "agro_industry_commerce",
        "office_furniture", "musical_instruments")),
    ("Services", (
        "insurance_services", "market_place")),
)

SHIPPED_PAYMENT_CATEGORIES = (
    ("credit_card", "Credit"),
    ("boleto", "Cash/Banking"),
    ("debit_card", "Debit"),
    ("voucher", "Voucher"),
    ("not_defined", "Unknown"),
)
# --------------------------- end of fixed values ---------------------------

# Labels used by the builders (fixed output vocabulary).
UNKNOWN_REGION = "Unknown"
OTHER = "Other"
UNCATEGORIZED = "uncategorized"
NO_PAYMENT_TYPE = "not_defined"
DELIVERED = "delivered"

SHIPPED_RULES = Rules(
    regions=SHIPPED_REGIONS,
    holidays=SHIPPED_HOLIDAYS,
    translations=SHIPPED_TRANSLATIONS,
    category_segments=SHIPPED_CATEGORY_SEGMENTS,
    payment_categories=SHIPPED_PAYMENT_CATEGORIES,
)


def _fixture_regions() -> tuple:
    names = ("North", "South", "East", "West")
    return tuple((name, tuple(f"NATION_{5 * i + j}" for j in range(5)))
                 for i, name in enumerate(names))


def _fixture_holidays() -> tuple:
    return tuple(f"{y}-{md}" for y in range(1995, 2002) for md in ("01-01", "12-25"))


FIXTURE_RULES = Rules(
    returning_max_orders=8,
    vip_min_orders=14,
    vip_min_value=100_000_000.0,
    lifespan_days=365,
    calendar_start=dt.date(1995, 1, 1),
    calendar_end=dt.date(2001, 6, 30),
    regions=_fixture_regions(),
    holidays=_fixture_holidays(),
    translations=(("ECONOMY", "economy"), ("STANDARD", "standard"), ("SMALL", "small"),
                  ("MEDIUM", "medium"), ("LARGE", "large")),
    category_segments=(("Basic", ("economy", "standard")),
                       ("Sized", ("small", "medium", "large")),
                       ("Extra", ("medium", "PROMO"))),
    payment_categories=SHIPPED_PAYMENT_CATEGORIES,
)


def first_group_of(groups: tuple) -> list[tuple[str, str]]:
    """Flatten (group, members) to (member, group) keeping the first group
    for a member listed more than once.  Works on configuration only."""
    seen: dict[str, str] = {}
    for group, members in groups:
        for m in members:
            seen.setdefault(m, group)
    return list(seen.items())
