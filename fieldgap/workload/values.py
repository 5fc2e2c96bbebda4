"""Names used when vehicle feeds are derived from the given tables."""

AS_OF_YEAR = 2025
FIRST_LOAD, SECOND_LOAD = "2024-01-01 06:00:00", "2024-02-01 06:00:00"
SNAPSHOTS = ("2024-01-01 00:00:00", "2024-04-01 00:00:00", "2024-07-01 00:00:00")

# Raw make and model spellings as they would arrive in complaints and recalls.
OBSERVED = [
    ("HONDA", "CIVIC"), ("Honda", "Civic Hybrid"), ("HONDA", "CR-V"), ("HONDA  ", "ACCORD  HYBRID"),
    ("TOYOTA", "CAMRY"), ("toyota", "Camry Solara"), ("TOYOTA", "RAV4"), ("TOYTOA", "CAMRY"),
    ("FORD", "F-150"), ("FORD", "F150 SUPERCREW"), ("FORD", "F-250 SD"), ("FORD", "F-150 RAPTOR"),
    ("CHEVROLET", "SILVERADO 1500"), ("CHEVY", "SILVERADO 2500 HD"), ("Chevy", "BOLT EV"),
    ("GMC", "SIERRA 2500 HD"), ("GMC", "SIERRA 1500"), ("MERCEDES BENZ", "C300"),
    ("MERCEDES", "AMG C43"), ("MERCEDES-BENZ", "SPRINTER 2500"), ("LEXUS", "RX 450H"),
    ("LEXUS", "ES350"), ("Lexus", "RX"), ("TESLA", "MODEL 3"), ("TESLA", "Model Y Long Range"),
    ("TESLA", "MODEL S"), ("VW", "JETTA"), ("VOLKSWAGEN", "Golf GTI"),
    ("LAND  ROVER", "RANGE ROVER SPORT"), ("LANDROVER", "DISCOVERY"), ("KIA", "SOULEV"),
    ("KIA", "SOUL EV"), ("HYUNDAI", "SANTA FE"), ("HYUNDAI", "Elantra GT"),
    ("HARLEY-DAVIDSON", "STREET GLIDE"), ("WINNEBAGO", "VISTA"), ("BMW", "328I"), ("BMW", "X5 M"),
    (None, "UNKNOWN"), ("NISSAN", "---"), ("NISSAN", None), ("ALFA-ROMEO", "Giulia"),
    ("SUBARU", "OUTBACK"), ("SUBARU", "Outback Wilderness"), ("JEEP", "GRAND CHEROKEE L"),
    ("JEEP", "GRAND CHEROKEE"), ("VOLVO", "XC90 T8"),
]

CAR, MPV, TRUCK = "Passenger Car", "Multipurpose Passenger Vehicle (MPV)", "Truck"
# Listed models: make, model id, model name, vehicle type.
LISTED = [
    ("HONDA", 1863, "Civic", CAR), ("HONDA", 1864, "CR-V", MPV), ("HONDA", 1861, "Accord", CAR),
    ("HONDA", 1861, "Accord", MPV), ("Toyota", 2469, "Camry", CAR), ("TOYOTA", 2472, "RAV4", MPV),
    ("FORD", 1801, "F-150", TRUCK), ("FORD", 1802, "F-250", TRUCK), ("FORD", 1999, "F 150", TRUCK),
    ("CHEVROLET", 1850, "Silverado", TRUCK), ("CHEVROLET", 27000, "Silverado HD", TRUCK),
    ("GMC", 1858, "Sierra", TRUCK), ("GMC", 27001, "Sierra HD", TRUCK),
    ("MERCEDES-BENZ", 2080, "C-Class", CAR), ("MERCEDES-BENZ", 2090, "Sprinter", TRUCK),
    ("LEXUS", 2147, "RX", MPV), ("LEXUS", 2148, "ES", CAR), ("TESLA", 17834, "Model 3", CAR),
    ("TESLA", 27037, "Model Y", MPV), ("TESLA", 2071, "Model S", CAR),
    ("VOLKSWAGEN", 3133, "Jetta", CAR), ("VOLKSWAGEN", 3134, "Golf", CAR),
    ("VOLKSWAGEN", 3135, "Golf GTI", CAR), ("LAND ROVER", 2030, "Range Rover", MPV),
    ("LAND ROVER", 2031, "Range Rover Sport", MPV), ("KIA", 2209, "Soul", MPV),
    ("HYUNDAI", 2033, "Santa Fe", MPV), ("HYUNDAI", 2034, "Elantra", CAR), ("BMW", 1707, "X5", MPV),
    ("ALFA ROMEO", 3500, "Giulia", CAR), ("SUBARU", 2223, "Outback", MPV),
    ("JEEP", 1943, "Grand Cherokee", MPV), ("VOLVO", 2201, "XC90", MPV),
]

COMPONENTS = [
    "FUEL SYSTEM, GASOLINE:DELIVERY:FUEL PUMP", "Engine", "AIR BAGS:FRONTAL", "SERVICE BRAKES",
    "ELECTRICAL SYSTEM: IGNITION", "power train:automatic transmission", "STEERING:COLUMN",
    "SUSPENSION:FRONT", "FLUX CAPACITOR:CORE", None, "EXTERIOR LIGHTING:HEADLIGHTS",
    "VISIBILITY/WIPER", "SERVICE BRAKES, HYDRAULIC:FOUNDATION COMPONENTS", "SEAT BELTS",
    "ENGINE AND ENGINE COOLING:COOLING SYSTEM", "ELECTRICAL SYSTEM", " WHEELS ", "UNKNOWN OR OTHER",
    "LATCHES/LOCKS/LINKAGES:DOORS", "HYBRID PROPULSION SYSTEM", "TIRES::TREAD",
]
STATES = ["CA", "TX", "FL", None, "NY", "WA", "OH", "MI", "GA"]
CHANNELS = ["IVOQ", "EVOQ", "MIVQ", None]
STARTERS = ["MFR", "ODI", "OVSC"]
POSITIONS = ["Front", "Rear", "", "Upstream"]
