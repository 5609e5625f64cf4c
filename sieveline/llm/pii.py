"""Problem 2: personal information in free text, by a linear-chain CRF.

The field is trained on a small labelled table of lines made by rule from the
clauses below, with names, numbers and often the words around them drawn at
random, so that it learns word shapes and contexts and not particular people.
What words look like includes whether a public vocabulary holds them whole, in
lower case or with a capital: most names it doesn't. Lines that could hold an
item are decoded by Viterbi in numpy batches. An exact check of each decoded
span (digits of a phone, both parts of a name and so on) follows.
"""

from __future__ import annotations

import base64
import os
import random
import re
from collections import Counter
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ship
from .boilerplate import brand_of
from .common import parsed_schema
from .packing import TOKENIZERS, VOCABULARY
from .visual import aligned, fold

KINDS = ("email", "phone", "id_number", "address", "name")
PLACEHOLDERS = {k: f"[{k.upper()}]" for k in KINDS}
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
K = len(TAGS)
SEED, TRAINED_SENTENCES, ROUNDS = 20, 22000, 110

# Words that give a token a class of its own.
CLASSES = {
    "street": "road rd street st avenue ave lane ln drive dr court ct terrace boulevard blvd hill way place pl square sq close crescent row mews weg strasse straße gasse platz allee rue via calle chemin parkway pkwy circle highway hwy quay walk grove gardens green",
    "unit": "flat apt apartment unit suite floor room house block",
    "title": "mr mrs ms miss dr prof chef sir dame professor doctor nurse judge captain",
    "kin": "aunt uncle auntie grandma granny grandpa gran nana cousin",
    "idword": "passport ssn social security national insurance id licence license driver driving identity nin nino citizen",
    "phoneword": "tel telephone phone call ring text fax mobile cell reached whatsapp dial hotline sms landline",
    "mailword": "mail email write under contact reply inbox mailbox gmail",
    "mailat": "at dot",
    "thing": "lot model packet item batch order serial isbn part code recipe edition error booklet sku invoice ticket barcode version page chapter volume reference request stock product article catalogue",
    "unitofmeasure": "minutes degrees grams percent kilos jars portions people mm cm ml litres ounces pounds cups hours days g kg",
    "month": "january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday mon tue wed thu fri sat sun",
    "dish": "soup stew pie curry salad tart cake loaf bread pancakes noodles casserole roast sauce risotto pudding pasta gratin bake hash chowder omelette pizza sandwich burger cookies muffins slaw skillet bowl wraps tacos chili relish jam pilaf porridge",
    "business": "ltd inc llc gmbh media team crew kitchen studio shop magazine journal network group company club press foods farm bakery restaurant cafe hotel school university museum",
    "menu": "home about contact newsletter search login recipes videos shop blog faq privacy policy terms share print subscribe comments reply cookies copyright rights reserved tags next previous",
}
CLASS_OF = {w: c for c, words in CLASSES.items() for w in words.split()}

# The labelled table is made of clauses: {slots} are labelled, <words> are not. None is taken from a table of texts.
CLAUSES = {
    "name": """
thanks to {name} for the tip about <food>
my neighbour {name} showed me how to salt <food>
{name} from the next village brought <food>
according to {name}, the trick is patience
{name} wrote to say that <food> works just as well
this comes from a notebook that {name} left behind
ask {name} about the oven, not me
our reader {name} suggests a pinch of <food>
adapted from {name}
by {name}
Photo: {name}
Words by {name}
Author: {name}
Contact: {name}
{name} and {name} run the stall by the river
the late {name} never wrote anything down
{name}, who taught me to bake, used <food>
we had lunch with {name} and talked about <food>
it was {name} who first burnt the <food>
for the birthday of {name} I doubled the <food>
{name}'s version has more <food>
{name}'s mother used a bigger pan
last week {name} won second prize with <food>
my colleague {name} is allergic to <food>
signed, {name}
- {name}
I owe this idea to {name}
as {name} used to tell us, less is more
{name} says so
when {name} came to stay, we cooked <food>
years ago {name} handed me a jar of <food>
{name} told {name} that the <food> was mine
interview with {name}
a letter from {name}
the winner is {name}
please give my regards to {name}
{name} taught the course on <food>
an old friend, {name}, keeps bees
Reviewed by reader {name}
{name} commented: too sweet
with {name} at the stove nothing goes wrong
{name} adds a spoon of <food> and stirs
I met {name} at a market
the landlady, {name}, grows <food>
mix it the way {name} does
""",
    "capitals": """
<w> <w> <Cap> <Cap> <w> <w>
<Cap> <Cap> <w> the <w>
<w> the <Cap> <Cap> <w> <w>
<Cap> <Cap>
<Cap> <Cap> <Cap>
<Title>
<Title>
<Title>
Before: <Title>
After: <Title> >>
<Title> - <Title>
<Title> (<nnn>)
posted in <w> <w>, <Brand> issue <nnnn>
<w> <w>, <Brand> <w> no. <nnnn>
a <w>, <Brand> <w> <w>
<Food>, <Food>, <Food>
(c) <year> <Brand> <Business>, <w> no. <nnn>
<Cap>: <Cap> <Cap>
<w> <Cap> <Cap> and <w>
<w> <w>? <Cap> <Brand> and <w>
<w> <Brand> - <nnnn> <w>
<w> and <w> are by <Brand>
<w> on the <Brand> <w>
<w> by the <Brand> <w> <w>
<w> to <Brand>; <w>
<Brand> <w> from <w>
<Cap> <Cap> <Brand> <w>
the <Variety> and the <Variety> <w>
<w> <w> <Variety> <w> until <w>
<w> the <Variety> over the <w>
<n> <w> <Variety>, <w>
<nnn> <w> <Variety>
<nn> <Cap> Road <w> into <w>
<n> <Cap> Road <w> and <w>
<w> <n> <Cap> Street <w> into <w>
<w> <nn> <Cap> Lane <w> on the <w>
<w> <nn> Street <Cap> <Cap> <w>
<w> <nn> Court <Cap> <w>
<nn> Place <Cap> and <w>
<w> the <nn> Road <Cap> <w> on the <w>
<w> the <nn> Street Food Market <w>
<nn> Hill <Cap> <w>
<w> <nn> <Cap> Street <w> and <w>
the <n> <Cap> Lane <w> <w>
<w> <nn> <Cap> Hill <w>
on the <Cap> Road <w>
<nn> <w> <Cap> <w>
<w> <nnn>-<n>-<nn>-<nnnnnn>-<n> <w>
<w> <nnnn>-<nnnn>-<nn> on the <w>
<w> packet <nnn>-<nn>-<nnnn> <w> the <w>
number <nnn>-<n>-<nn>-<nnnnnn>-<n>
model <A>-<nnn>-<nnnn> <w>
item <nnnnnnnnnn> <w> the <w>
request <nnnnnnn> was <w>
reference <nnnnnn>
<nn>g  <nn>g  <nn>  <nnn>
<n>.<nnn> <n>.<nnn> <n>.<nnn>
<nnn>  <nn>g  -  <nnn>  <nn>
<food> .... <nn>.<n> .... <nnn>
<w> <w> <w> <w> <w> <w>
""",
    "phone": """
call {phone}
call us on {phone} before noon
phone: {phone}
Tel {phone}
Telephone {phone}
my number is {phone}
send a text to {phone} and I bring the <food>
reach me at {phone}
WhatsApp {phone} for orders
or dial {phone} after six
Mobile: {phone}
fax {phone}
the shop answers at {phone}
leave a message on {phone}
phone {phone} if the <food> is late
her landline is {phone}
{phone} is the farm, ask for eggs
orders under {phone} only
book a table, {phone}
if in doubt, {phone} is open all day
you get through on {phone} most days
""",
    "email": """
write to {email}
email {email}
e-mail me at {email}
send photos to {email}
questions go to {email}
reply to {email} by Monday
drop a line to {email}
my address is {email}
contact {email} for the list
{email} is the quickest way
mail your own <food> recipe to {email}
Email: {email}
the list is kept by {email}
(see {email})
you can find me under {email}
complaints about <food> go straight to {email}
""",
    "id": """
passport number {passport}
passport no. {passport}
her passport {passport} was in the drawer
Passport: {passport}
social security number {ssn}
SSN {ssn}
SSN: {ssn}
his social security no. is {ssn}
national insurance number {nino}
NI number {nino}
insurance no. {nino}
driver's license {licence}
driving licence number {licence}
licence no. {licence}
driver licence {licence} expired in March
national ID {national}
identity card number {national}
ID number {national}
ID no. {national}
identity no. {national}
the form shows {ssn} beside my name
a slip with {ssn} fell out of the book
somebody wrote {nino} on the lid
the copy shows passport {passport}
they wanted my {label} {ssn}
""",
    "address": """
at {address}
we live at {address}
the bakery at {address} closes early
come to {address} for a taste
send the tins to {address}
Address: {address}
pick it up from {address}
visit us: {address}
I bought the <food> at {address}
my parents moved to {address}
parcels go to {address}, please
the class meets at {address} on Fridays
{address}
opposite {address} there is a mill
deliveries to {address} take a week
she grew up in {address}
the market is near {address}
""",
    "mixed": """
{name}, {address}
{name} ({email})
{name}, {phone}
{name} - {phone}
{name} <{email}>
{name} lives at {address}
{phone} / {email}
{address}, tel. {phone}
{email}, {phone}
{name} of {address} sent this in
ask {name} at {phone} for <food>
{name}; {address}; {phone}; {email}
{name} can be reached under {email}
write to {name} at {address}
{name} holds passport {passport}
""",
    "plain": """
the <food> should be golden and crisp
stir the <food> into the <food> and cook for <nn> minutes
bake at <nnn> degrees for <nn> minutes
preheat the oven to <nnn> degrees F
add <n> cups <food> and a pinch of <food>
<n> tablespoons <food>, chopped
<n>/<n> cup <food>
<nnn> g <food>
<Variety> works better than <Variety>
two <Variety> and a jar of <food>
sliced <Variety>, cored
a cup of <Variety> on the side
we served <Variety> with <Variety> and <food>
use <Variety> if you can get it
<Title>
<Title> with <Food>
Next: <Title>
Read also: <Title>
More: <Title>, <Title>
<Brand> is a trademark of <Brand> <Business>
© <year> <Brand>
© <year>-<year> <Brand>. All rights reserved.
Copyright <year> <Brand> <Business>
welcome to <Brand>, your place for <food>
The <Brand> team tests every <food>
brought to you by <Brand> <Business>
Read more on <Brand>
Follow <Brand> for more <food>
subscribe to the <Brand> newsletter
the <Brand> kitchen uses <food>
a recipe from <Brand> <Business>, tested in <year>
Privacy Policy | Terms of Use | Contact Us
Home | About | Recipes | Search
Sign In / Sign Up
Leave A Comment
Related Recipes
Share This: Mail Print
my aunt <given> likes it sweet
Uncle <given> laughed
<given> and I ate the rest
<given> prefers <food>
dear <given>, try it with <food>
for <given>, with love
Happy Birthday <given>!
lot <nnnn>-<nn> of the <food> was off
Lot <nnnnnn>
batch <nnnnnnnn>
Model <A><nnnn>-<nn> has a timer
order number <nnnnnnnnnn>
order no. <nnn>-<nnnnnnn>
item <nnnnnnnnn> in the catalogue
ISBN <nnn>-<n>-<nnnn>-<nnnn>-<n>
serial <A><A><nnnnnnnn>
article <nn>.<nnn>.<nn>
SKU <nnnnn>-<nnn>
part no. <nnn>-<nn>-<nnnn> fits the mixer
code <nnn>-<nn>-<nnnn> on the bag of <food>
barcode <nnnnnnnnnnnnn>
error code <nnnn>
error <nnn>, see page <nn>
reference <nnnnnnnn> was not found
seed bag <nnn>-<nn>-<nnnn>
between <year> and <year> it sold well
it cost <n>.<nn> per kilo
<n>.<nn> @ <nn> each
meet@<n> for <food>
lunch@home means <food>
the file is called <food>_<nn>_final
open from <nn>:<nn> to <nn>:<nn>
on <nn>/<nn>/<year> we tried <food>
updated <nn>.<nn>.<year>
ratio <n>:<n>, or <nn>:<nn>
<n> x <nn> cm tin
<nnn>-<nnn> calories
Calories <nnn>, Fat <nn>g, Protein <nn>g
Energy <nnn> kJ
<n>) <food>
Step <n>: fold in the <food>
In New York they call it <food>
a South Indian dish from Tamil Nadu
the Hudson Valley in October
on Easter Sunday we eat <food>
Merry Christmas and a Happy New Year
Wall Street lunch bars sell it
Oxford Street was full, so we cooked <food>
<nn> Main Street bars tried the <food>
the <n> Garden Lane loaves sold out
take <nn> River Road buns and slice them
He read it at night and left at dawn
look at the dot in the middle
come in at two
<food>, <food>, <food>, <food>
<Food>, <Food>, <Food>
<Food> | <Food> | <Food>
<Food>: <nn>
Dutch Oven <Title>
Instructions
Ingredients
Notes
Nutrition
Nutrition Information
Values per <nnn> grams
<nn>) <Variety>, <food>, <Variety>
<n>/<n> teaspoon <Variety>
No <Variety>? Take <Variety>
add the <Variety> and the <Variety>
<Variety>, <Food> and a <Variety>
wash at <nn> degrees with <food>
Swiss Army knife, French Press, Bunsen Burner
Bluetooth Wi-Fi USB
""",
}
#: Varieties, drinks and dishes with the look of a person's name.
VARIETIES = "Granny Smith|Earl Grey|Lady Grey|Monterey Jack|Pepper Jack|Pink Lady|Bloody Mary|Red Leicester|Double Gloucester|Golden Delicious|King Edward|Desiree Rose|Uncle Ben|Victoria Plum|Bramley Seedling|Cox Orange|Honey Crisp|Royal Gala|Eton Mess|Caesar Salad|Beef Wellington|Peach Melba|Pavlova Rose|Charlotte Russe|Anjou Pear|Bartlett Pear|San Marzano|Brandy Alexander|Tom Collins|Shirley Temple|Arnold Palmer|Irish Coffee|Blue Stilton|Mary Rose|Maris Piper|Jersey Royal|Charlotte Potato|Cripps Pink|Jack Daniels|Jerusalem Artichoke|Savoy Cabbage|Roma Tomato|Kung Pao|Tikka Masala|Dijon Mustard|Worcester Sauce|Nashi Pear|Colby Jack|Baby Bella|Aunt Jemima|Betty Crocker|Captain Morgan|Johnny Apple|Prince Albert|Queen Anne|Black Forest|Tarte Tatin|Crêpe Suzette|Oysters Rockefeller|Eggs Benedict|Swiss Chard|Brussels Sprouts|Dutch Oven|Gruyère".split("|")
LOOK_LIKE_NAMES = frozenset(v.lower() for v in VARIETIES)
FOODS = "butter|flour|brown sugar|lemon juice|black pepper|oats|cinnamon|cream|lentils|tomatoes|a little salt|rice|chicken thighs|garlic|pumpkin|vinegar|baking soda|almonds|dark chocolate|yoghurt|spinach|beans|crème fraîche|jalapeño|sesame oil|white wine|chives|mushrooms|cod|ginger".split("|")
GIVEN = "Laura Thomas Hannah Felix Bridget Omar Priya Carlos Ingrid Wei Fatima Andrew Julia Stefan Rosa Viktor Elena Samuel Naomi Pierre Agnes Dmitri Chloe Marcus Yusuf Beatrice Hiroshi Amara Leon Katarina Diego Fiona Walter Zainab Ruth Pablo Signe Arthur Mei Tomas Claire Henrik Ayesha Martin Olga Lucas Edith Rajesh Helen Bruno".split()
FAMILY = "Baker Johnson Nguyen Müller Rossi Kowalski Fernandez O'Brien Okafor Larsen Dubois Ivanova Tanaka Williams Petrov Schmidt Silva Novak Andersson McCarthy Haddad Chen Kapoor Weber Moreau Lopez Wright Jansen Costa Bianchi Fischer Murphy Ahmed Svensson Popescu Turner Campbell Hughes".split()
ADJECTIVES = "Quick Easy Classic Spicy Crunchy Roasted Homemade Lazy Grilled Sweet Hearty Vegan Golden Baked Warm Summer Winter Rustic Simple Best Nutty Peppery Savoury Savory Buttery Smoky Zesty Tangy Spiced Herbed Braised Slow Creamy Fluffy Sticky Glazed Stuffed Pickled Toasted Chilled Crispy Fried Moist Juicy Fresh Festive Cosy Old-Fashioned No-Bake No-Cook Two-Minute Sheet-Pan Gluten-Free Low-Fat Overnight Everyday Sunday".split()
THINGS = "Garden Table Oven Market River Stone Apple Bread Basil Honey Pepper Olive Corner Valley Spice Butter Hill Rose Wooden Copper Little Green Blue Happy Bright Orange Onion Lemon Carrot Potato Ginger Mint Fennel Tofu Chicken Walnut Bakery Home Kitchen Pantry Fork Plate Pan Whisk Larder Cranberry Lentil Parsnip Blueberry Raspberry Pea Leek Cauliflower Broccoli Plum Cherry Peach Rye Oat Almond Pecan Caper Celery Turnip Beetroot Cabbage Bean Chickpea Mushroom Spinach Shrimp Salmon Turkey Beef Pork Lamb Mushroom Sesame Cocoa Chocolate Coconut Mango Banana Fig Date Rhubarb Apricot Squash Zucchini Barley Corn Hearth Ladle Thistle Pebble Sorrel Rosemary Sage Thyme Tarragon Anise Saddle Lantern Kettle Anchor Feather Meadow Willow Maple".split()
DISHES = [w.capitalize() for w in CLASSES["dish"].split()] + "Dumplings Galette Relish Crumble Flatbread Biscuits Wedges Skewers Fritters Rolls Bites Bars Dip Spread Broth Stir-Fry Casserole".split()
CLASS_OF |= {w.lower(): "cook" for w in (*THINGS, *ADJECTIVES, *DISHES) if w.lower() not in CLASS_OF}
COMPANIES = "Ltd Inc LLC GmbH Media Group Kitchen Foods Magazine Network Press Studio".split()
TOWNS = "Springfield Millbrook Weston Riverside Lyon Bergen Kilmore Aldham Porto Leeds Hanover Graz Fairview Marlow Oakdale".split()
STREETS = "Road Rd Rd. Street Street St St. Avenue Ave Ave. Lane Lane Ln Drive Dr. Court Terrace Boulevard Blvd Close Crescent Way Place Square Hill Row Mews Parkway Grove Gardens Walk".split()
DOMAINS = "gmail.com yahoo.co.uk outlook.de proton.me webmail.net hotmail.fr icloud.com uni-graz.at company.org fastmail.io example.com mail.example.net".split()

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")


def _made_up(r: random.Random, low: int = 2, high: int = 3) -> str:
    """A word that no list holds: syllables drawn at random."""
    syllable = lambda: r.choice("b br c ch cl cr d dr f fl g gr h j k kl l m n p pr qu r s sh st t th tr v w wh y z".split()) + r.choice("a e i o u ai ea ee ou".split()) + r.choice(["", "", *"n r l m s t th nd x ck".split()])
    word = "".join(syllable() for _ in range(r.randint(low, high)))
    return word[:1].upper() + word[1:]


def _compound(r: random.Random) -> str:
    """A word of two known ones, as many family and place names are."""
    return r.choice(THINGS) + r.choice("son man ley ton ham field wood berg stein by ford well worth shaw ski dale house bury ick ridge er".split())


def _given(r: random.Random) -> str:
    return r.choice(GIVEN) if r.random() < 0.4 else _made_up(r, 1, 3)


def _family(r: random.Random) -> str:
    x = r.random()
    if x < 0.3:
        return r.choice(FAMILY)
    if x < 0.55:
        return _compound(r)
    if x < 0.63:
        return r.choice(THINGS)
    made = _made_up(r, 1, 3)
    return f"{made}-{_made_up(r, 1, 2)}" if x > 0.97 else r.choice(["O'", "Mc", "Mac", "van ", "de "]) + made if x > 0.92 else made


def _name(r: random.Random) -> str:
    given, family = _given(r), _family(r)
    x = r.random()
    if x < 0.16:
        out = f"{family}, {given}"
    elif x < 0.3:
        out = f"{given} {r.choice('ABCDEFGHIJKLMNOPRSTW')}. {family}"
    elif x < 0.34:
        out = f"{given} {_given(r)} {family}"
    elif x < 0.37:
        out = f"{given[0]}. {family}"
    else:
        out = f"{given} {family}"
    if r.random() < 0.08:
        out = out.upper()
    return (r.choice(["Mr. ", "Dr. ", "Chef ", "Mrs. ", "Ms. ", "Mr ", "Prof. "]) if r.random() < 0.12 and "," not in out else "") + out


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _formed(r: random.Random, form: str) -> str:
    """A form with digits for ``#`` and capitals for ``@``."""
    return "".join(r.choice("0123456789") if c == "#" else r.choice("ABCDEFGHJKLMNPRSTWXYZ") if c == "@" else c for c in form)


PHONES = "##########|##########|+1 ### ### ####|1-###-###-####|###-###-####|(###) ###-####|+1 (###) ###-####|###.###.####|##########|+44 #### ######|0#### ######|0044 #### ######|00## (0)#### ### ###|0## #### ####|+49 ## #######|+49 (0)## ########|+33 # ## ## ## ##|0# ## ## ## ##|+1 (###) ###.####|+## ### ### ###|###/#######|0### #######|+86 1## #### ####|+1-###-###-####|### ### ####|0##########".split("|")
PASSPORTS = "@########|@##@##@##|#########|@@#######|##@@#####|@#######".split("|")
LICENCES = "@#######|@###-####-####|@@-###-###-###|@@@@@######@@#@@|@############|########|@## ### ###|##-###-####".split("|")
NATIONALS = "#########|############|########-@|##########-@|########@|##################|###-###-###|######-####|#.##.##.###.###|#########-@".split("|")


def _phone(r: random.Random) -> str:
    return _formed(r, r.choice(PHONES))


def _address(r: random.Random) -> str:
    d = lambda n: str(r.randrange(10 ** (n - 1), 10**n))
    road = r.choice(["", "", "", "", "Old ", "New ", "Upper ", "West ", "N. "]) + _family(r) + r.choice(["", "", "", "", " Hill", " Mill", " Park"])
    town = r.choice(["", "", "", "Lower ", "East ", "St. "]) + (r.choice(TOWNS) if r.random() < 0.5 else _family(r))
    number = d(r.choice([1, 2, 2, 3, 3, 4])) + r.choice(["", "", "", "", "", "a", "B", "-" + d(1)])
    street = f"{number} {road} {r.choice(STREETS)}"
    made = _made_up(r, 1, 3)
    other = r.choice([f"{made}{r.choice(['straße', 'strasse', 'weg', 'gasse', 'allee', 'platz', 'gatan', 'laan', 'straat'])} {number}", f"{number} {r.choice(['rue de', 'rue', 'chemin de', 'avenue'])} {made}", f"{r.choice(['Calle', 'Via', 'Rua', 'Plaza'])} {made} {number}", f"{number} {made} {_made_up(r, 1, 2)}, {town}"])
    code = r.choice([_formed(r, x) for x in ("@@ #####", "#####", "@@# #@@", "@@## #@@", "@# #@@", "@@#####")])
    x = r.random()
    if x < 0.2:
        return other + r.choice(["", f", {_digits(r, 5)} {town}", f", {town}"])
    return r.choice([f"{street}, {town}, {code}", f"{street}, {town} {code}", f"{street}, Apt {d(2)}B, {town}", f"{street}, Apt. {d(1)}", f"{street}, Suite {d(3)}", f"{street} in {town}", f"Flat {d(1)}, {street}, {town} {code}", f"Unit {d(2)}, {street}", street, street, street, street, f"{street}, {town}"])


def _email(r: random.Random) -> str:
    given, family = _given(r).lower().replace("'", ""), _family(r).lower().replace("'", "").replace(" ", "")
    local = r.choice([f"{given}.{family}", f"{given}{_digits(r, 2)}", f"{family}_{given}", f"{family}-{given[0]}", f"{given[0]}{family}", f"{given}", f"{given}.{family}+list", f"info", f"{family}{_digits(r, 4)}", f"{given}_{family[0]}"])
    domain = r.choice(DOMAINS) if r.random() < 0.4 else r.choice([_made_up(r).lower(), r.choice(THINGS).lower() + r.choice(THINGS).lower(), f"{r.choice(THINGS).lower()}-{_made_up(r).lower()}", "post." + _made_up(r).lower()]) + r.choice([".com", ".org", ".net", ".test", ".example", ".co.uk", ".de", ".invalid", ".info"])
    at, dot = r.choice([("@", "."), ("@", "."), ("@", "."), ("@", "."), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."), (" (at) ", " (dot) "), (" @ ", "."), ("[at]", "[dot]"), (" AT ", " DOT "), ("{at}", "{dot}")])
    out = f"{local.replace('.', dot) if dot not in ('.', ' [dot] ') and r.random() < 0.3 else local}{at}{domain.replace('.', dot)}"
    if r.random() < 0.06:
        out = "mailto:" + out
    return out.upper() if r.random() < 0.05 else out


MAKERS = {
    "name": _name, "phone": _phone, "address": _address, "email": _email, "passport": lambda r: _formed(r, r.choice(PASSPORTS)), "ssn": lambda r: _formed(r, r.choice(["###-##-####", "### ## ####", "#########", "###-##-####"])),
    "nino": lambda r: _formed(r, r.choice(["@@ ## ## ## @", "@@######@", "@@ ###### @", "@@-##-##-##-@"])), "licence": lambda r: _formed(r, r.choice(LICENCES)), "national": lambda r: _formed(r, r.choice(NATIONALS)),
}
SLOT_KIND = dict.fromkeys(("passport", "ssn", "nino", "licence", "national"), "id_number")
#: How often each sort of clause is drawn.
SHARES = {"name": 8, "anywhere": 18, "capitals": 20, "phone": 5, "email": 4, "id": 6, "address": 7, "mixed": 5, "plain": 20}


def lexicon_of(tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> tuple[frozenset[str], frozenset[str]]:
    """Words that a public vocabulary holds whole in lower case, and with a capital. Most names are in neither, or in the second only."""
    with open(os.path.join(tokenizers, vocabulary), "rb") as f:
        tokens = [base64.b64decode(line.split()[0]) for line in f]
    # a token that begins with a blank begins a word
    whole = [t[1:].decode() for t in tokens if len(t) > 3 and t[:1] == b" " and t[1:].isalpha() and t.isascii()]
    return frozenset(w for w in whole if w.islower()), frozenset(w.lower() for w in whole if w.istitle())


def _words(r: random.Random, lexicon: tuple[frozenset[str], frozenset[str]]) -> dict:
    """Makers of what is not labelled."""
    common = sorted(lexicon[0])
    word = lambda: r.choice(common) if r.random() < 0.9 else r.choice(common) + r.choice(common)
    brand = lambda: " ".join(r.choice(THINGS) if r.random() < 0.7 else word().capitalize() for _ in range(2))
    food = lambda: r.choice(FOODS) if r.random() < 0.8 else _made_up(r).lower()
    title = lambda: " ".join([r.choice(ADJECTIVES), *[r.choice(THINGS) for _ in range(r.randint(0, 2))], r.choice(DISHES)])
    return {
        "food": food, "Food": lambda: food().title(), "Variety": lambda: r.choice(VARIETIES), "Title": title, "Brand": brand, "Business": lambda: r.choice(COMPANIES), "given": lambda: _given(r),
        "w": word, "Cap": lambda: (r.choice(THINGS) if r.random() < 0.3 else word().capitalize()), "label": lambda: r.choice(["SSN", "social security number", "number"]), "year": lambda: f"{r.choice(['19', '20'])}{_digits(r, 2)}", "A": lambda: r.choice("ABCDEKMRTX"),
    }


def _anywhere(r: random.Random) -> str:
    """A pattern of one to three items with words of any sort around them."""
    near = lambda low, high: [r.choice(["<w>", "<w>", "<w>", "the", "a", "and", "my", "in", "of", "to", "it", "<food>"]) for _ in range(r.randint(low, high))]
    labels = {"passport": ["passport", "passport number", "passport no."], "licence": ["driver licence no.", "licence", "driving licence"], "nino": ["national insurance number", "NI number"], "national": ["national ID", "ID no.", "identity number"], "ssn": ["SSN", "SSN:", "social security number", "", "", ""]}
    kinds = ["name"] * 10 + ["phone"] * 4 + ["email"] * 3 + ["address"] * 5 + ["ssn"] * 3 + ["passport", "licence", "nino", "national"]
    out = near(0, 4)
    for i in range(r.choice([1, 1, 1, 2, 2, 3])):
        slot = r.choice(kinds)
        item = " ".join(x for x in (r.choice(labels.get(slot, [""])), "{%s}" % slot) if x)
        form = r.choice(["%s"] * 12 + ["(%s)", "%s,", "%s,", "%s;", "%s:", "%s.", "%s -", "%s's" if slot == "name" else "%s"])
        if out and r.random() < 0.2:
            out[-1] += r.choice([",", ",", ":", ";", " -", "."])
        before = r.choice(["by", "from", "with", "to", "of", "at", "under", "on", "for"]) if r.random() < 0.35 else ""
        out += [x for x in (before, form % item) if x] + near(0 if i else 1, 3)
    return " ".join(out)


def _clause(r: random.Random, words: dict, pattern: str) -> tuple[str, list[tuple[int, int, str]]]:
    text, spans = "", []
    for piece in re.split(r"(\{\w+\}|<\w+>)", pattern):
        if piece[:1] == "{":
            slot = piece[1:-1]
            value = MAKERS[slot](r) if slot in MAKERS else words[slot]()
            if slot in MAKERS:
                spans.append((len(text), len(text) + len(value), SLOT_KIND.get(slot, slot)))
        elif piece[:1] == "<" and piece[1:-1] in words:
            value = words[piece[1:-1]]()
        elif piece[:1] == "<" and set(piece[1:-1]) == {"n"}:
            value = _digits(r, len(piece) - 2)
        else:
            value = piece
        text += value
    return text, spans


def labelled_table(lexicon: tuple[frozenset[str], frozenset[str]], seed: int = SEED, size: int = TRAINED_SENTENCES) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """``(line, [(start, end, kind)])``: the training table, lines of one to four clauses drawn by rule."""
    r = random.Random(seed)
    words = _words(r, lexicon)
    sorts = [k for k, n in SHARES.items() for _ in range(n)]
    patterns = {k: v.strip().split("\n") for k, v in CLAUSES.items()}
    out = []
    for i in range(size):
        text, spans = "", []
        for k in range(r.choice([1, 1, 1, 2, 2, 3, 4])):
            sort = r.choice(sorts) if not k or r.random() < 0.5 else "plain"
            clause, own = _clause(r, words, _anywhere(r) if sort == "anywhere" else r.choice(patterns[sort]))
            if k:
                text += r.choice([". ", ". ", ", ", "; ", ", and ", " - ", "! ", ", but ", " (", ": "])
            if clause[:1].islower() and (not text or text[-2:] in (". ", "! ")) and r.random() < 0.9:
                clause = clause[:1].upper() + clause[1:] if not own or own[0][0] > 0 else clause
            spans += [(a + len(text), b + len(text), kind) for a, b, kind in own]
            text += clause
        text += r.choice([".", ".", ".", "", "", "!", "?"])
        if r.random() < 0.16:
            up = text.upper()
            text = up if len(up) == len(text) else text
        if r.random() < 0.06:
            mark = r.choice(["1. ", "- ", "* ", "2) "])
            text, spans = mark + text, [(a + len(mark), b + len(mark), kind) for a, b, kind in spans]
        out.append((text, spans))
    return out


@lru_cache(maxsize=200_000)
def token_features(token: str, glued: bool, pattern: str = "") -> tuple[tuple[str, str], ...]:
    """What is seen of one token: spelling, shape, ends, class, whether it hangs on the last one, and the pattern of the number it is part of."""
    low = token.lower()
    shape = re.sub(r"[^\W\d_]", "x", re.sub(r"[A-ZÀ-Ý]", "X", token))
    shape = re.sub(r"\d", "d", shape)
    if "d" not in shape:
        shape = re.sub(r"(.)\1+", r"\1\1", shape)
    elif len(shape) > 10:
        shape = "d+"
    feats = [("w", low), ("s", shape), ("g", f"{shape[:2]}{int(glued)}")]
    if token[0].islower() or token[0].isalpha() and len(token) > 7:  # ends of short capitalised words tell nothing of people
        feats += [("e", low[-3:]), ("b", low[:3])]
    elif token[0].isdigit():
        feats.append(("n", f"{len(token)}{int(glued)}"))
        feats.append(("9", token[0]))
    if c := CLASS_OF.get(low):
        feats.append(("c", c))
    if pattern:
        feats.append(("p", pattern))
    return tuple(feats)


def word_class(token: str, pattern: str, lexicon: tuple[frozenset[str], frozenset[str]]) -> tuple[tuple[str, str], ...]:
    """Whether the lexicon holds a word in lower case and with a capital, and how it is written here."""
    if not token[0].isalpha() or len(token) < 2:
        return ()
    low = token.lower()
    written = "A" if pattern == UPPER else "U" if token.isupper() else "C" if token[0].isupper() else "l"
    return (("v", f"{written}{int(low in lexicon[0])}{int(low in lexicon[1])}"),)


#: Offsets at which each family of features is read.
OFFSETS = {"w": (-3, -2, -1, 0, 1, 2), "s": (-3, -2, -1, 0, 1, 2, 3), "g": (-1, 0, 1, 2), "e": (0,), "b": (0,), "n": (-2, -1, 0, 1, 2), "9": (0,), "c": (-3, -2, -1, 0, 1, 2, 3), "p": (-1, 0, 1), "v": (-3, -2, -1, 0, 1, 2, 3)}
REACH = 3
#: Lines that a spelling, an end or a beginning must stand in to count.
FREQUENT = {"w": 6, "e": 20, "b": 20}
BOUNDARY = (("w", ""), ("s", ""))


def _allowed() -> np.ndarray:
    """Transitions that the BIO scheme allows."""
    ok = np.ones((K, K), bool)
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            for i, before in enumerate(TAGS):
                ok[i, j] = before[2:] == tag[2:] and before != "O"
    return ok


class Crf:
    """Weights of the field: by feature and offset, and by transition."""

    def __init__(self, weights: dict[tuple[int, str, str], np.ndarray], transitions: np.ndarray, start: np.ndarray, lexicon: tuple[frozenset[str], frozenset[str]]):
        self.weights, self.transitions, self.start, self.lexicon = weights, transitions, start, lexicon
        self.types: dict[tuple[str, bool, str], int] = {}
        self.rows = np.zeros((1024, 2 * REACH + 1, K), np.float32)
        self.boundary = self._row(None)

    def __reduce__(self):
        return Crf, (self.weights, self.transitions, self.start, self.lexicon)

    def _row(self, key) -> int:
        """The scores that a token type adds to its neighbours, by offset; kept in one growing matrix."""
        n = len(self.types)
        if n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.types[key] = n
        for family, value in (*token_features(*key), *word_class(key[0], key[2], self.lexicon)) if key else BOUNDARY:
            for o in OFFSETS[family]:
                if (w := self.weights.get((o, family, value))) is not None:
                    self.rows[n, o + REACH] += w
        return n

    def ids(self, tokens: list[tuple[str, bool, str]]) -> list[int]:
        if len(self.types) > 300_000:  # rare spellings never end; start again
            self.types.clear()
            self.rows[:] = 0
            self.boundary = self._row(None)
        known = self.types
        return [known[t] if t in known else self._row(t) for t in tokens]

    def decode(self, lines: list[list[int]]) -> list[np.ndarray]:
        """Best tags of each line of token types, by Viterbi over batches of similar length."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(lines)
        order = sorted((i for i in range(len(lines)) if lines[i]), key=lambda i: len(lines[i]))
        at = 0
        while at < len(order):
            width = len(lines[order[at]])
            end = at
            while end < len(order) and end - at < 2048 and len(lines[order[end]]) <= width * 1.15 + 4:
                end += 1
            batch = order[at:end]
            at = end
            T = len(lines[batch[-1]])
            ids = np.full((len(batch), T + 2 * REACH), self.boundary, np.int32)
            length = np.array([len(lines[i]) for i in batch])
            for b, i in enumerate(batch):
                ids[b, REACH : REACH + length[b]] = lines[i]
            emit = np.zeros((len(batch), T, K), np.float32)
            for o in range(-REACH, REACH + 1):
                emit += self.rows[ids[:, REACH + o : REACH + o + T], o + REACH]
            score = emit[:, 0] + self.start
            back = np.zeros((T, len(batch), K), np.int8)
            for t in range(1, T):
                way = score[:, :, None] + self.transitions[None]
                back[t] = way.argmax(1)
                best = np.take_along_axis(way, back[t][:, None, :].astype(np.int64), 1)[:, 0] + emit[:, t]
                score = np.where((t < length)[:, None], best, score)
            tags = np.zeros((len(batch), T), np.int8)
            last = score.argmax(1)
            tags[np.arange(len(batch)), length - 1] = last
            for t in range(T - 1, 0, -1):
                step = back[t][np.arange(len(batch)), last]
                last = np.where(t < length, step, last)
                live = t - 1 < length
                tags[live, t - 1] = last[live]
            for b, i in enumerate(batch):
                out[i] = tags[b, : length[b]]
        return out


#: Pattern of tokens outside numbers in a line of capitals alone, where capitals tell nothing.
UPPER = "U"
NUMBER = re.compile(r"\d[\d.,:/-]*\d|\d")


def tokenize(text: str) -> tuple[list[tuple[str, bool, str]], list[tuple[int, int]]]:
    """Tokens as (spelling, hangs on the last one, pattern of its number or ``UPPER``), and their places."""
    tokens, places, end = [], [], -1
    numbers = [(m.start(), m.end(), re.sub(r"\d", "d", m[0]) if m.end() - m.start() <= 16 else "d+") for m in NUMBER.finditer(text)]
    upper = UPPER if text.isupper() else ""
    at = 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while at < len(numbers) and numbers[at][1] <= a:
            at += 1
        tokens.append((m[0], a == end, numbers[at][2] if at < len(numbers) and numbers[at][0] <= a else upper))
        places.append((a, b))
        end = b
    return tokens, places


MODEL = "pii_model.npz"


def save(model: Crf, path: str = os.path.join(os.path.dirname(os.path.abspath(__file__)), MODEL)) -> None:
    """Weights as half floats and one text of their keys; the lexicon stays where it is."""
    keys = sorted(model.weights)
    np.savez_compressed(path, keys=np.array("\n".join(f"{o}\t{f}\t{v}" for o, f, v in keys)), weights=np.array([model.weights[k] for k in keys], np.float16), transitions=model.transitions, start=model.start)


@lru_cache(maxsize=2)
def trained(tokenizers: str = TOKENIZERS) -> Crf:
    """The field as ``save(train())`` left it in the package; ``train`` makes it anew from the labelled table in a minute or two."""
    with resources.files(__package__).joinpath(MODEL).open("rb") as f, np.load(f) as z:
        keys = [k.split("\t") for k in str(z["keys"]).split("\n")]
        return Crf({(int(o), f, v): w for (o, f, v), w in zip(keys, z["weights"].astype(np.float32))}, z["transitions"], z["start"], lexicon_of(tokenizers))


def train(seed: int = SEED, size: int = TRAINED_SENTENCES, rounds: int = ROUNDS, penalty: float = 0.5, tokenizers: str = TOKENIZERS) -> Crf:
    """Maximum likelihood by Adam on the labelled table; forward-backward runs over all sentences at once."""
    lexicon = lexicon_of(tokenizers)
    table = labelled_table(lexicon, seed, size)
    index: dict[tuple[int, str, str], int] = {}
    types: dict = {None: 0}
    gold, lengths, sequence = [], [], []
    for text, spans in table:
        tokens, places = tokenize(text)
        sequence.append([types.setdefault(t, len(types)) for t in tokens])
        for a, b in places:
            tag = 0
            for s, e, kind in spans:
                if s <= a and b <= e:
                    tag = TAGS.index(("B-" if a == s else "I-") + kind)
            gold.append(tag)
        lengths.append(len(places))
    gold = np.array(gold)
    span = 2 * REACH + 1
    # spellings and ends seen in few lines tell of these lines only; without them shape, lexicon and context must carry the rest
    seen = Counter(x for ids in sequence for x in set(ids))
    counts: Counter = Counter()
    for key, n in types.items():
        for x in token_features(*key) if key else ():
            if x[0] in FREQUENT:
                counts[x] += seen[n]
    # (type, offset) rows are sums of feature weights; tokens are sums of rows
    feature, row = [], []
    for key, n in types.items():
        by_offset: list[list[int]] = [[] for _ in range(span)]
        for family, value in (*token_features(*key), *word_class(key[0], key[2], lexicon)) if key else BOUNDARY:
            if key and counts.get((family, value), FREQUENT.get(family, 0)) < FREQUENT.get(family, 0):
                continue
            for o in OFFSETS[family]:
                by_offset[o + REACH].append(index.setdefault((o, family, value), len(index)))
        for o, ids in enumerate(by_offset):
            feature += ids
            row += [n * span + o] * len(ids)
    feature, row = np.array(feature), np.array(row)
    r_starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    filled = row[r_starts]
    by_feature = np.argsort(feature, kind="stable")
    f_starts = np.flatnonzero(np.r_[True, feature[by_feature][1:] != feature[by_feature][:-1]])
    near = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.array([0] * REACH + ids + [0] * REACH), span) for ids in sequence]) * span + np.arange(span)
    sorts = []
    for o in range(span):
        order = np.argsort(near[:, o], kind="stable")
        cuts = np.flatnonzero(np.r_[True, near[order, o][1:] != near[order, o][:-1]])
        sorts.append((order, cuts, near[order, o][cuts]))
    B, T = len(lengths), max(lengths)
    place = np.full((B, T), -1)
    at = 0
    for b, k in enumerate(lengths):
        place[b, :k] = np.arange(at, at + k)
        at += k
    mask = place >= 0
    W, A, S = np.zeros((len(index), K), np.float32), np.zeros((K, K)), np.zeros(K)
    barred = np.where(_allowed(), 0.0, -1e4)
    first_barred = np.where([t[0] == "I" for t in TAGS], -1e4, 0.0)
    onehot = np.eye(K, dtype=np.float32)[gold]
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (W, A, S)]
    pair_gold = np.zeros((K, K))
    for b, k in enumerate(lengths):
        np.add.at(pair_gold, (gold[place[b, : k - 1]], gold[place[b, 1:k]]), 1)
    for step in range(1, rounds + 1):
        rows = np.zeros((len(types) * span, K), np.float32)
        rows[filled] = np.add.reduceat(W[feature], r_starts)
        emit = rows[near[:, 0]]
        for o in range(1, span):
            emit += rows[near[:, o]]
        x = np.where(mask[..., None], np.exp(emit - emit.max(1, keepdims=True))[np.maximum(place, 0)], 1.0)
        M = np.exp(A + barred)
        alpha, beta, scale = np.zeros((B, T, K)), np.ones((B, T, K)), np.ones((B, T, 1))
        front = np.exp(S + first_barred) * x[:, 0]
        for t in range(T):
            if t:
                front = np.where(mask[:, t, None], (alpha[:, t - 1] @ M) * x[:, t], alpha[:, t - 1])
            scale[:, t] = front.sum(1, keepdims=True)
            alpha[:, t] = front / scale[:, t]
        pair = np.zeros((K, K))
        for t in range(T - 1, 0, -1):
            ahead = np.where(mask[:, t, None], x[:, t] * beta[:, t] / scale[:, t], 0.0)
            pair += (alpha[:, t - 1].T @ ahead) * M
            beta[:, t - 1] = np.where(mask[:, t, None], ahead @ M.T, 1.0)
        marginal = alpha * beta
        diff = onehot - marginal[mask].astype(np.float32)
        rows[:] = 0
        for order, cuts, where in sorts:
            rows[where] += np.add.reduceat(diff[order], cuts)
        gW = np.add.reduceat(rows[row[by_feature]], f_starts)
        grads = (gW - penalty * W, pair_gold - pair - penalty * A, onehot[place[:, 0]].sum(0) - marginal[:, 0].sum(0) - penalty * S)
        for value, g, m in zip((W, A, S), grads, moments):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            value += 0.2 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    weights = {k: W[i].astype(np.float32) for k, i in index.items() if np.abs(W[i]).max() > 5e-2}
    return Crf(weights, (A + barred).astype(np.float32), (S + first_barred).astype(np.float32), lexicon)


SIGNED_MAIL = re.compile(r"(?:mailto:)?[\w.+-]+\s*(?:@|[\[({]\s*at\s*[\])}])\s*[\w-]+(?:\s*(?:\.|[\[({]\s*dot\s*[\])}]|\bdot\b)\s*[\w-]+)+", re.I)
MAIL = re.compile(r"[\w.+-]+\s*(?:@|[\[({]\s*at\s*[\])}]|\bat\b)\s*[\w-]+(?:\s*(?:\.|[\[({]\s*dot\s*[\])}]|\bdot\b)\s*[\w-]+)+", re.I)
_CAPITAL = r"(?:[dDlLO]['’]|[vV]an |[vV]on |[dD]e |[dD]el |[lL]a )?[A-ZÀ-Ý][\w'’-]*"
FULL_NAME = re.compile(rf"(?:(?:Mr|Mrs|Ms|Miss|Dr|Prof|Chef|Sir|Dame|Professor|Doctor|MR|MRS|MS|DR|CHEF|PROF)\.? )?{_CAPITAL}\.?(?:,? {_CAPITAL}\.?){{1,3}}")
WORDY = re.compile(r"[^\W\d_]+")
URL = re.compile(r"https?://\S+")
#: What an exact check below asks for at the least; a line without any of these holds no item that could pass.
WRITTEN_AT = re.compile(r"@|\bat\b", re.I)
NUMBERED = re.compile(r"\d[\w/-]*,? +[A-ZÀ-Ý]|\d[\w/-]*,? +\w+ +[A-ZÀ-Ý]|[A-ZÀ-Ý][\w'’-]+\.?,? +(?:no\. ?)?\d")
HOUSE_FIRST = re.compile(r"\d[\w/-]*,? +(?:\w+ +)?[A-ZÀ-Ý]")
#: Where the number comes last, the street says so itself.
HOUSE_LAST = re.compile(r"(?:(?:stra(?:ß|ss)e|str\.|weg|gasse|allee|platz|gata?n?|laan|straat|vej|ring|damm|ufer)|\b(?:rue|via|calle|rua|plaza|avenida|avenue|piazza|chemin|street|road|lane|place)\b.*) +(?:no\. ?)?\d", re.I)
TWO_CAPITALS = re.compile(r"[A-ZÀ-Ý][\w'’-]*\.?,? +(?:(?:van|von|de|del|la) )?(?:[dl]['’])?[A-ZÀ-Ý]")


def possible(line: str) -> bool:
    """Whether the line can hold a span that ``valid`` lets pass: it asks for no more than ``valid`` does."""
    if "@" in line or TWO_CAPITALS.search(line) or sum(map(line.count, "0123456789")) >= 6 or NUMBERED.search(line):
        return True
    return " at" in line.lower() and WRITTEN_AT.search(line) is not None and "dot" in line.lower() or "(at)" in line.lower() or "[at]" in line.lower() or "{at}" in line.lower()


def valid(kind: str, span: str) -> bool:
    """The exact check of a decoded span."""
    digits = sum(map(str.isdigit, span))
    if kind == "email":
        return MAIL.search(span) is not None
    if kind == "phone":
        return 7 <= digits <= 15 and re.search(r"-\d-|\t| {2}|[^\d\s()/.+-]", span) is None
    if kind == "id_number":
        return digits >= 6 and re.search(r"[;%\t]|  ", span) is None
    if kind == "address":
        return digits >= 1 and (HOUSE_FIRST.search(span) or HOUSE_LAST.search(span)) is not None and re.search(r"[A-ZÀ-Ý][\w'’-]{2}", span) is not None
    return FULL_NAME.fullmatch(span) is not None and len({w.lower() for w in WORDY.findall(span)}) > 1 and not any(v in span.lower() for v in LOOK_LIKE_NAMES)


def brand_places(text: str, brand: str) -> list[tuple[int, int]]:
    """Where a line spells the site's name, blanks and signs aside."""
    if not brand or brand[:3] not in (low := text.lower()):
        return []
    pieces = [("and", i, i + 1) if c == "&" else (c, i, i + 1) for i, c in enumerate(low) if c == "&" or c.isascii() and c.isalnum()]
    squeezed, starts, ends = "".join(p[0] for p in pieces), [i for p in pieces for i in [p[1]] * len(p[0])], [i for p in pieces for i in [p[2]] * len(p[0])]
    return [(starts[m.start()], ends[m.end() - 1]) for m in re.finditer(re.escape(brand), squeezed)]


def spans(text: str, places: list[tuple[int, int]], tags, brand: str = "", common: frozenset[str] = frozenset()) -> list[tuple[int, int, str]]:
    """Checked ``(start, end, kind)`` of a tagged line. A site's own name is a brand, not a person.

    In a line of capitals alone a name must do without ``common`` words: nothing else tells it from them there.
    """
    out: list[list] = []
    for (a, b), t in zip(places, tags):
        if t == 0:
            continue
        tag = TAGS[t]
        if tag[0] == "B" or not out or out[-1][2] != tag[2:]:
            out.append([a, b, tag[2:]])
        else:
            out[-1][1] = b
    for span in out:
        # "me at" before an address with a sign of its own is no part of it
        if span[2] == "email" and (m := SIGNED_MAIL.search(text, span[0], span[1])):
            span[:2] = m.span()
    own = brand_places(text, brand) if out else []
    if common and out and text.isupper():
        out = [x for x in out if x[2] != "name" or common.isdisjoint(w.lower() for w in WORDY.findall(text, x[0], x[1]))]
    return [(a, b, kind) for a, b, kind in out if valid(kind, text[a:b]) and not (kind in ("name", "address") and any(x < b and a < y for x, y in own))]


def find(model: Crf, texts: list[str | None], urls: list[str | None] | None = None) -> list[list[tuple[int, str, list[tuple[int, int, str]]]]]:
    """For each text its lines with items: ``(line index, folded line, spans)``; one batch of Viterbi for all."""
    jobs, ids = [], []
    for n, text in enumerate(texts):
        if not text:
            continue
        for i, line in enumerate(fold(text).split("\n")):
            # addresses of pages and pictures are no text; a mail address is none of these
            shown = URL.sub(lambda m: " " * len(m[0]), line) if "://" in line else line
            if possible(shown):
                tokens, places = tokenize(shown)
                jobs.append((n, i, line, places))
                ids.append(model.ids(tokens))
    out: list[list] = [[] for _ in texts]
    for (n, i, line, places), tags in zip(jobs, model.decode(ids)):
        if tags.any() and (got := spans(line, places, tags, brand_of(urls[n]) if urls else "", model.lexicon[0])):
            out[n].append((i, line, got))
    return out


def _map(df: DataFrame, key: str, text: str, url: str | None, model: Crf, rows, ddl: str) -> DataFrame:
    ship(df.sparkSession)
    schema = parsed_schema(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            keys, texts, urls = (c.to_pylist() for c in batch.columns)
            for at in range(0, len(keys), 512):
                part = texts[at : at + 512]
                made = [x for k, t, found in zip(keys[at : at + 512], part, find(model, part, urls[at : at + 512])) for x in rows(k, t, found)]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)

    return df.select(F.col(key), F.col(text), (F.col(url) if url else F.lit(None).cast("string")).alias("_url")).mapInArrow(run, schema)


def found(df: DataFrame, key: str, text: str, model: Crf | None = None, url: str | None = None) -> DataFrame:
    """``key, line_no, kind``: kinds of items on each line, one row for each kind. Null texts have none; no shuffle.

    With ``url``, the name of a row's own site is no person's name.
    """
    kind = df.schema[key].dataType.simpleString()

    def rows(k, t, lines):
        for i, _, got in lines:
            for what in sorted({x[2] for x in got}):
                yield k, i + 1, what

    return _map(df, key, text, url, model or trained(), rows, f"`{key}` {kind}, line_no int, kind string")


def replaced(own: str, line: str, got: list[tuple[int, int, str]]) -> str:
    """A line with placeholders for the spans found in its folded form; all else keeps its own characters."""
    plain, starts = aligned(own)
    if plain != line:  # accents that compose across what lies between them
        own, starts = line, list(range(len(line) + 1))
    for a, b, kind in reversed(got):
        end = starts[b]
        own = own[: starts[a]] + PLACEHOLDERS[kind] + own[end:]
    return own


def masked(df: DataFrame, key: str, text: str, model: Crf | None = None, url: str | None = None) -> DataFrame:
    """``key, clean``: each text with its items replaced by placeholders of their kind.

    Everything else stays as it is, character by character. Null stays null,
    empty stays empty.
    """
    kind = df.schema[key].dataType.simpleString()

    def rows(k, t, lines):
        if t is not None and lines:
            own = t.split("\n")
            for i, line, got in lines:
                own[i] = replaced(own[i], line, got)
            t = "\n".join(own)
        yield k, t

    return _map(df, key, text, url, model or trained(), rows, f"`{key}` {kind}, clean string")
