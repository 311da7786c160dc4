"""Class codes, epochs and thresholds that results depend on.

Country codes (249 numeric ISO codes to alpha-3) are no constant here but a
dimension table with the columns ``code`` and ``alpha3``, passed where needed.
"""

from __future__ import annotations

# Fixed values, from here to the end of this file.

LAND_COVER = {
    0: "Bare and sparse vegetation",
    1: "Short vegetation",
    2: "Tree cover",
    3: "Wetland – short vegetation",
    4: "Water",
    5: "Snow/ice",
    6: "Cropland",
    7: "Built-up",
    8: "Cultivated grasslands",
}

NATURAL_LANDS = {
    2: "Natural forests",
    3: "Natural short vegetation",
    4: "Natural water",
    5: "Mangroves",
    6: "Bare",
    7: "Snow",
    8: "Wetland natural forests",
    9: "Natural peat forests",
    10: "Wetland natural short vegetation",
    11: "Natural peat short vegetation",
    12: "Cropland",
    13: "Built-up",
    14: "Non-natural tree cover",
    15: "Non-natural short vegetation",
    16: "Non-natural water",
    17: "Wetland non-natural tree cover",
    18: "Non-natural peat tree cover",
    19: "Wetland non-natural short vegetation",
    20: "Non-natural peat short vegetation",
    21: "Non-natural bare",
}

DISTURBANCE_DRIVERS = {1: "Wildfire", 2: "Flooding", 3: "Crop management", 4: "Potential conversion", 5: "Unclassified"}

LOSS_DRIVERS = {
    0: "Unknown",
    1: "Permanent agriculture",
    2: "Hard commodities",
    3: "Shifting cultivation",
    4: "Logging",
    5: "Wildfire",
    6: "Settlements & Infrastructure",
    7: "Other natural disturbances",
}
#: The stored loss tables spell one driver differently.
LOSS_DRIVERS_STORED = LOSS_DRIVERS | {6: "Settlements and infrastructure"}

NATURAL_FORESTS = {0: "Unknown", 1: "Natural Forest", 2: "Non-Natural Forest"}
NATURAL_FORESTS_STORED = NATURAL_FORESTS | {2: "Non-natural Forest"}
#: Natural-lands classes that make a natural or a planted forest.
NATURAL_FOREST_CLASSES, PLANTED_FOREST_CLASSES = (2, 5, 8, 9), (14, 17, 18)

CONFIDENCE = {2: "low", 3: "high", 4: "highest"}
CONFIDENCE_DISTURBANCE = {2: "low", 3: "high"}

CANOPY_PERCENT = {0: 0, 1: 10, 2: 15, 3: 20, 4: 25, 5: 30, 6: 50, 7: 75}
CARBON_THRESHOLDS = (30, 50, 75)
GAIN_PERIODS = {0: "", 1: "2000-2005", 2: "2005-2010", 3: "2010-2015", 4: "2015-2020"}
LOSS_YEAR_BASE = 2000
NATURAL_GRASSLAND = 2

#: Day 0 of the two alert products; an encoded alert is 10000 * confidence + days.
DISTURBANCE_EPOCH, INTEGRATED_EPOCH, CONFIDENCE_FACTOR = "2020-12-31", "2014-12-31", 10_000

VEGETATION = {0: "excluded", 1: "tree_loss", 2: "tree_gain", 3: "trees_remaining_trees", 4: "non_trees_remaining_non_trees"}
LAND_STATES = {
    1: (
        10200000, 11100000, 12100000, 12200000, 12300000, 12400000, 12500000, 12600000, 12700000, 13100000, 31120000,
        31190000, 31211200, 31211900, 31212200, 31212900, 31221200, 31221900, 31222200, 31222900, 31231200, 31231900,
        31232200, 31232900, 31241200, 31242200, 32112000, 32119000, 32121200, 32121900, 32122200, 32122900, 32132000,
        32139000, 32142000, 32212000, 32219000, 32222000, 32229000, 32232000, 32239000, 32242000, 41200000, 41900000,
    ),
    2: (10000000, 11200000, 21100000, 21200000, 22100000, 22200000),
    3: (
        13200000, 42111120, 42111190, 42111220, 42111290, 42112120, 42112190, 42112220, 42112290, 42121120, 42121190,
        42121220, 42121290, 42122120, 42122190, 42122220, 42122290, 42211200, 42211900, 42212200, 42212900, 42221120,
        42221190, 42221212, 42221219, 42221222, 42221229, 42222200, 42222900,
    ),
    4: (
        10100000, 51000000, 52120000, 52190000, 52220000, 52320000, 52390000, 53200000, 53900000, 61000000, 62120000,
        62220000, 62290000, 63200000, 63900000,
    ),
    0: (70000000,),
}

INVENTORY_YEARS = tuple(range(2016, 2025))
INVENTORY_BLOCKS = {2020: tuple(range(2016, 2021)), 2024: tuple(range(2021, 2025))}

CROPS = (
    "Banana", "Barley", "Bean", "Cassava", "Chickpea", "Coconut", "Cocoa", "Arabica Coffee", "Robusta Coffee", "Cotton",
    "Cowpea", "Groundnut", "Lentil", "Maize", "Pearl Millet", "Small Millet", "Oil Palm", "Pigeon Pea", "Plantain",
    "Potato", "Rapeseed", "Rice", "Sesame Seed", "Sorghum", "Soybean", "Sugarbeet", "Sugarcane", "Sunflower",
    "Sweet Potato", "Tea", "Tobacco", "Wheat", "Yams", "Other Cereals", "Other Fibre Crops", "Other Oil Crops",
    "Other Pulses", "Other Roots", "Rest of Crops", "Temperate Fruit", "Tropical Fruit", "Vegetables",
)
GASES = ("CO2e", "CO2", "CH4", "N2O")
