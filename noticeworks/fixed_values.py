"""Values fixed by the procurement portal, its code nomenclature and the analysis.

Nothing here is logic: every literal has to equal the published value for
results to be right, so they are kept together, as plain text.
"""

# Notice types (2 participation notice, 7 concession, 12 invitation).
ALL_NOTICE_TYPES = [2, 7, 12]
DETAIL_NOTICE_TYPES = [2, 7]
PARTICIPATION_TYPE = "2"

# Procedure state "awarded", as text and as id.
AWARDED_TEXT = "Atribuita"
AWARDED_ID = 5

# Ingest range, rows the list API returns at most per call, rows of a result page.
FIRST_MONTH = "2022-01-01"
LAST_MONTH = "2026-12-01"
RESULT_CAP = 3000
PAGE_SIZE = 2000

# Fixed value: id used downstream when a detail document carries none.
DEFAULT_DOCUMENT_ID = "111"

# Sampling.
SAMPLE_SIZE = 30
SAMPLE_SEED = 42
SAMPLE_CATEGORIES = [
    "Electrical and electronic equipment used in the healthcare sector",
    "Food",
    "Furniture",
]

# Energy criteria (product groups of the model document, category, criterion name).
ENERGY_PRODUCT_GROUPS = [11, 12]
ENERGY_CATEGORY = "Petroleum products, fuel, electricity and other sources of energy"
GREEN_ENERGY_NAME = "Energie verde"

# Suffixes of signed attachments.
SIGNED_SUFFIXES = [".p7m", ".p7s"]

# JSON keys of one award criterion, in output order.
CRITERION_KEYS = [
    "noticeID",
    "lotID",
    "noticeAwardCriteriaID",
    "directProportional",
    "noticeAwardCriteriaName",
    "noticeAwardCriteriaDescription",
    "algorithmDescription",
    "noticeAwardCriteriaOrder",
    "noticeAwardCriteriaWeight",
    "isElectronicCriteria",
    "isFrameworkAgreementCriteria",
]

# JSON keys of a match response.
RESPONSE_KEYS = [
    "match",
    "criteria_from_actual_contract_in_original_romanian",
    "criteria_from_actual_contract_translated_in_english",
]

# Long labels of detail fields.
FIELD_LABELS = {
    "personalSituation": "III.1.1) Ability to perform professional activity, including requirements for enrollment in the professional or trade registers:",
    "tpCriteriaQAStandardMin": "Nivel(uri) minim(e) al(e) standardelor care ar putea fi impuse",
    "tpCriteriaQAStandard": "Listă şi descriere succintă a criteriilor de selecţie",
}

# Social taxonomy, title and definition.
SOCIAL_TAXONOMY = {
    "A. Social Return (employment of disadvantaged groups) ": "Clauses requiring or incentivising the contractor to employ people from disadvantaged / vulnerable groups (young people, Roma, disabled, etc.) or to create training/apprenticeship places, linked to the specific contract. Or giving priorities to social-economy actors or entities employing disadvantaged people. ",
    "B. Decent Work & Labour Conditions ": "Clauses about respecting labour law, ILO conventions, transparent and predictable working conditions, health & safety, non-exploitative conditions – both in Romania and in global supply chains. ",
    "C. Accessibility & Design for All ": "Accessibility for persons with disabilities and older people in goods, services and works – and any “design for all” requirements.",
    "D. Equality, Diversity & Non-Discrimination ": "Measures promoting gender equality, equal pay, non-discrimination (race, ethnicity, disability, age, etc.), diversity in the workforce, work–life balance",
    "E Human Rights & Ethical Trade": "Explicit “ethical trade”, “responsible sourcing” or “international social conditions” requirements: human rights, due diligence, risk mapping in global supply chains, especially high-risk sectors (textiles, electronics, agro-food, etc.). ",
}

# Category -> procurement-code prefixes (codes carry leading zeros, so text).
SOCIAL_CATEGORIES = {
    "Computers, monitors, tablets, smartphones": ["302", "3225"],
    "Copy paper and graphic paper": ["301976"],
    "Image processing equipment, consumables for image processing equipment": ["3012"],
    "Furniture": ["391"],
    "Indoor cleaning products": ["398"],
    "Food": ["15"],
    "Textile products": ["192", "395"],
    "Electrical and electronic equipment used in the healthcare sector": ["331"],
    "Products for arranging/maintaining public green spaces": ["43325", "1615", "4511271", "7731", "142123"],
    "Hot water heating plants (boilers)": ["42161"],
    "Road lighting and road signaling systems": ["3499"],
    "Road transport vehicles": ["341"],
    "Data centers, server rooms, and cloud services": ["723", "4882"],
    "Catering services": ["555"],
    "Indoor cleaning services": ["9091"],
    "Paints, varnishes, and road markings": ["44811", "34922"],
    "Public space maintenance services/works": ["906", "7731", "4511271", "5023", "4523329", "77314"],
    "Road transport services": ["601"],
    "Printing services": ["7981"],
    "Design, construction, and management of buildings": ["71221", "4521", "79993"],
    "Design, construction, and maintenance of roads": ["45233"],
    "Textile-related services (washing, repairing, maintenance, collection of textiles)": ["5083", "98312", "51543"],
}

ENTERPRISE_CATEGORIES = {
    "Miscellaneous services": ["983"],
    "Entertainment services": ["923"],
    "Works for complete or part construction and civil engineering work": ["452"],
    "Miscellaneous food products": ["158"],
    "Miscellaneous business and business-related services": ["799"],
    "Health services": ["851"],
    "Restaurant and food-serving services": ["553"],
    "Adult and other education services": ["804"],
    "Repair, maintenance and associated services of vehicles and related equipment": ["501"],
    "Camping sites and other non-hotel accommodation": ["552"],
    "Road transport services": ["601"],
    "Fruit, vegetables and related products": ["153"],
    "Site preparation work": ["451"],
    "Social work and related services": ["853"],
    "Cleaning and sanitation services": ["909"],
    "Building installation work": ["453"],
    "Furniture": ["391"],
    "Business and management consultancy and related services": ["794"],
    "Horticultural services": ["773"],
    "Structural products": ["442"],
    "Building completion work": ["454"],
    "Market and economic research; polling and statistics": ["793"],
    "Printing and related services": ["798"],
    "Engineering services": ["713"],
    "Training services": ["805"],
    "Canteen and catering services": ["555"],
    "Beverage-serving services": ["554"],
    "Sporting services": ["926"],
    "Miscellaneous fabricated products and related items": ["444"],
    "Construction materials and associated items": ["441"],
    "Software programming and consultancy services": ["722"],
    "Hire of construction and civil engineering machinery and equipment with operator": ["455"],
    "Retail trade services": ["559"],
    "Recruitment services": ["796"],
    "Banking and investment services": ["661"],
    "Forestry and logging products": ["034"],
    "Dairy products": ["155"],
    "Textile articles": ["395"],
    "Animal products, meat and meat products": ["151"],
    "Animal feedstuffs": ["157"],
    "Outerwear": ["182"],
    "Data services": ["723"],
    "Water transport services": ["606"],
    "Membership organisation services": ["981"],
    "Veterinary services": ["852"],
    "Food, beverages, tobacco and related products": ["150"],
    "Sports goods and equipment": ["374"],
    "Office-support services": ["795"],
    "Miscellaneous repair and maintenance services": ["508"],
    "Tanks, reservoirs and containers; central-heating radiators and boilers": ["446"],
    "Technical testing, analysis and consultancy services": ["716"],
    "Internet services": ["724"],
    "Refuse and waste related services": ["905"],
    "Personal care products": ["337"],
    "Furnishing": ["392"],
    "Administration services": ["751"],
    "Recreational, cultural and sporting services": ["920"],
    "Architectural and related services": ["712"],
    "Accounting, auditing and fiscal services": ["792"],
    "Motion picture and video services": ["921"],
    "Clothing, footwear, luggage articles and accessories": ["180"],
    "Cargo handling and storage services": ["631"],
    "Travel agency, tour operator and tourist assistance services": ["635"],
    "Post and courier services": ["641"],
    "Garments": ["183"],
    "Real estate agency services on a fee or contract basis": ["703"],
    "Medical equipments": ["331"],
    "Hotel services": ["551"],
    "Library, archives, museums and other cultural services": ["925"],
    "Agricultural, farming, fishing, forestry and related products": ["030"],
    "Cable, wire and related products": ["443"],
    "Agricultural services": ["771"],
    "Textile fabrics and related items": ["192"],
    "Stone for construction, limestone, gypsum and slate": ["449"],
    "Repair, maintenance and associated services related to personal computers, office equipment, telecommunications and audio-visual equipment": ["503"],
    "Renting or leasing services of own property": ["702"],
    "Electricity, heating, solar and nuclear energy": ["093"],
    "Special clothing and accessories": ["184"],
    "Forestry services": ["772"],
    "Investigation and security services": ["797"],
    "Agricultural and horticultural products": ["031"],
    "Fuels": ["091"],
    "Animal or vegetable oils and fats": ["154"],
    "Jewellery, watches and related articles": ["185"],
    "Rubber and plastic materials": ["195"],
    "Motor vehicles": ["341"],
    "Musical instruments, sport goods, games, toys, handicraft, art materials and accessories": ["370"],
    "Games and toys; fairground amusements": ["375"],
    "Furniture (incl. office furniture), furnishings, domestic appliances (excl. lighting) and cleaning products": ["390"],
    "Cleaning and polishing products": ["398"],
    "Support services for land, water and air transport": ["637"],
    "Telecommunications services": ["642"],
    "Computer-related services": ["725"],
    "Research and experimental development services": ["731"],
    "Miscellaneous non-metallic mineral products": ["148"],
    "Beverages, tobacco and related products": ["159"],
    "Footwear": ["188"],
    "Office machinery, equipment and supplies except computers, printers and furniture": ["301"],
    "Pharmaceutical products": ["336"],
    "Domestic appliances": ["397"],
    "Tools, locks, keys, hinges, fasteners, chain and springs": ["445"],
    "Repair and maintenance services for pumps, valves, taps and metal containers and machinery": ["505"],
    "Supporting and auxiliary transport services; travel agencies services": ["630"],
    "Primary education services": ["801"],
    "Cereals, potatoes, vegetables, fruits and nuts": ["032"],
    "Petroleum products, fuel, electricity and other sources of energy": ["090"],
    "Sand and clay": ["142"],
    "Grain mill products, starches and starch products": ["156"],
    "Agricultural machinery": ["160"],
    "Occupational clothing, special workwear and accessories": ["181"],
    "Leather": ["191"],
    "Fertilisers and nitrogen compounds": ["244"],
    "Fine and various chemical products": ["249"],
    "Computer equipment and supplies": ["302"],
    "Electricity distribution and control apparatus": ["312"],
    "Electronic, electromechanical and electrotechnical supplies": ["317"],
    "Radio, television, communication, telecommunication and related equipment": ["320"],
    "Parts and accessories for vehicles and their engines": ["343"],
    "Motorcycles, bicycles and sidecars": ["344"],
    "Musical instruments and parts": ["373"],
    "Miscellaneous general and special-purpose machinery": ["429"],
    "Repair, maintenance and associated services related to aircraft, railways, roads and marine equipment": ["502"],
    "Insurance and pension services": ["665"],
    "Secondary education services": ["802"],
    "Sewage services": ["904"],
    "Private households with employed persons": ["985"],
}

INFRA_CATEGORIES = {
    "Petroleum products, fuel, electricity and other sources of energy": ["09"],
    "Public utilities": ["65"],
    "Construction work": ["45"],
}
