"""Hand-made listing rows covering the quirks listed in FIXTURES.md section 1."""

LISTING_SCHEMA = (
    "id long, Price double, Type_of_sale string, Starting_price boolean, sale_annuity double, "
    "Subtype string, Kitchen_type string, State_of_building string, epc string, "
    "locality_name string, street string, number string, Postal_code string, "
    "latitude double, longitude double, Swimming_Pool boolean, hasTerrace boolean, "
    "terraceSurface double, hasGarden boolean, gardenSurface double, Furnished boolean, "
    "Number_of_bedrooms double, Number_of_facades double, Living_area double, landSurface double, "
    "sparse_30 double, sparse_40 double")

LISTING_ROWS = [
    # id, Price, sale, Start, annuity, Subtype, Kitchen, State, epc, locality, street, number,
    # Postal, lat, lon, pool, terrace, tSurf, garden, gSurf, furnished, bed, facades, living,
    # land, sparse_30, sparse_40
    (1, 300000.0, "RESIDENTIAL_SALE", False, None, "HOUSE", "INSTALLED", "GOOD", "B",
     "Tielt (8700)", "Kerkstraat", "5", "8700", 50.99, 3.33, True, True, 12.0, True, None,
     False, 3.0, 4.0, 150.0, 400.0, 1.0, None),
    (2, 450000.0, "RESIDENTIAL_SALE", True, None, "VILLA", "HYPER_EQUIPPED", "AS_NEW", "A",
     "BRAINE-L'ALLEUD", "avenue de la paix", "12", "1420", None, None, None, False, None,
     True, 300.0, None, 4.0, 4.0, 220.0, 900.0, 2.0, None),
    (3, None, "RESIDENTIAL_SALE", None, None, "APARTMENT_BLOCK", None, "TO_RENOVATE", "F",
     "Gent", None, None, "9000", None, None, False, None, None, None, None, None, 2.0,
     2.0, 90.0, None, 3.0, None),
    (4, 250000.0, "LIFE_ANNUITY", None, 800.0, "TOWN_HOUSE", "INSTALLED", "GOOD", "nan",
     "Antwerpen", "Meir", "1", "2000", 51.22, 4.40, None, True, None, False, None, False,
     2.0, 2.0, 110.0, 120.0, None, 1.0),
    (4, 260000.0, "RESIDENTIAL_SALE", False, None, "TOWN_HOUSE", "INSTALLED", "GOOD", "C",
     "Antwerpen", "Meir", "1", "2000", 51.22, 4.40, None, True, None, False, None, False,
     2.0, 2.0, 110.0, 120.0, None, 2.0),
    (5, 199000.0, "RESIDENTIAL_SALE", False, None, "HOUSE", "NOT_INSTALLED", "TO_BE_DONE_UP",
     "G", "Namur", "Rue X", "3", "50000", None, None, False, False, None, False, None,
     False, 3.5, 3.0, 130.0, 200.0, None, None),
    (6, 210000.0, "RESIDENTIAL_SALE", False, None, "HOUSE", None, "GOOD", "A++", "Mons",
     "Rue Y", "7", "700", 50.45, 3.95, False, False, None, True, 50.0, False, 3.0, None,
     None, None, None, None),
    (7, 320000.0, "RESIDENTIAL_SALE", False, None, "MANSION", "INSTALLED", "JUST_RENOVATED",
     "B", "Leuven", "Rue Y", "7", "3000", 50.88, 4.70, False, True, 20.0, False, None,
     True, 4.0, 4.0, 200.0, 500.0, None, 3.0),
    (8, 280000.0, "RESIDENTIAL_SALE", False, None, "BUNGALOW", "INSTALLED", "Nan", "D",
     "Leuven", "Rue Y", "7", "3000", 50.88, 4.70, False, False, None, False, None,
     False, 2.0, 3.0, 100.0, 300.0, None, 4.0),
    (9, 230000.0, "RESIDENTIAL_SALE", False, None, "HOUSE", "INSTALLED", "GOOD", "E",
     "Aalst", "Street Z", None, "9300", 50.94, 4.07, False, False, None, False, None,
     False, 3.0, 2.0, 120.0, 250.0, None, 5.0),
]


def listings(spark):
    return spark.createDataFrame(LISTING_ROWS, LISTING_SCHEMA)
