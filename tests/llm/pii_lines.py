"""Lines with their items, written for the test of personal data: none of their wordings, names, towns or domains stands in the labelled table."""

LINES = [
    ("Passport number 533401234 was printed on the slip.", "id_number"),
    ("Her NI number is JK 48 20 17 A and she never forgot it.", "id_number"),
    ("National insurance: PW112233B", "id_number"),
    ("He noted the SSN 512-44-9087 on a napkin.", "id_number"),
    ("social security 431 22 7765 is what the clerk typed", "id_number"),
    ("My driving licence MORGA753116SM9IJ is in the glovebox.", "id_number"),
    ("Driver's license: K4490123, issued last spring.", "id_number"),
    ("The national identity number 880412-5567 belongs on the first line.", "id_number"),
    ("Please quote passport C01X00T47 when you book the cooking class.", "id_number"),
    ("ID card: 294837561, valid until June", "id_number"),
    ("You can ring the farm shop under 01632 960 447 all week.", "phone"),
    ("Our new number: (415) 555-2671", "phone"),
    ("For bread orders the line is +44 20 7946 0018.", "phone"),
    ("Give me a shout on 07911 123456 if the jam has not set.", "phone"),
    ("Tel: 212.555.0187", "phone"),
    ("She picks up on 503-555-0142, mostly.", "phone"),
    ("Reservations +1 646 555 0109", "phone"),
    ("Phone orders are taken on 0131 496 0512 until five.", "phone"),
    ("My cell is 3105550136, text before you drive over.", "phone"),
    ("In Germany you reach the mill on +49 40 5556789.", "phone"),
    ("Let me know at anneke.visser@brightmail.nl how it turned out.", "email"),
    ("Send the scan to j_pereira84@quickmail.pt please.", "email"),
    ("My mail is sonja at tulipfarm dot nl, no spaces.", "email"),
    ("Get in touch: hello@brunswickbees.com.au", "email"),
    ("The list lives with gord.tremblay [at] maplebox [dot] ca now.", "email"),
    ("You may write me, kiri(at)southpost.co.nz, for a starter.", "email"),
    ("Corrections? editor@thelittleloaf.ie", "email"),
    ("Orders over mail only: o.brandt@kuechenpost.de", "email"),
    ("lucia_ferro@casaferro.it sends the pasta shapes chart.", "email"),
    ("Ping noah.k@oatmail.se and he will share the sheet.", "email"),
    ("We collected the honey from 48 Birchwood Avenue.", "address"),
    ("Drop off the jars at 7 Quarry Lane, Haddington, EH41 3RQ.", "address"),
    ("The stall moved to 2210 Sycamore Street, Boulder, CO 80302 this year.", "address"),
    ("Old sign over the door of 15 Kirkgate Close: fresh eggs.", "address"),
    ("My flat is 9 Harbour Crescent, Flat 3, second bell.", "address"),
    ("You will find the shop in Lindenstraße 44, 50674 Köln.", "address"),
    ("Post your entry to 301 Westfield Road, Unit 12.", "address"),
    ("They baked in the cellar of 86 Chandler Boulevard.", "address"),
    ("Turn left after 1440 Pinecrest Drive and you smell the bread.", "address"),
    ("Returns: 5 Tannery Yard Place, Norwich NR2 4TB", "address"),
    ("The dumplings were folded by Margaret Ellison on a rainy day.", "name"),
    ("Last autumn Tobias Lindqvist gave me his starter.", "name"),
    ("I learned to pluck a goose from Gwendolyn Pritchard.", "name"),
    ("Nobody makes borscht like Oksana Melnyk.", "name"),
    ("Recipe courtesy of Sanjay Deshpande", "name"),
    ("Then Rebecca Stonehouse opened the door and the soufflé fell.", "name"),
    ("We toasted Hollis, Adrian for the best crust.", "name"),
    ("Mrs. Philippa Crane kept geese behind the school.", "name"),
    ("It was Kwame A. Boateng who brought the plantains.", "name"),
    ("Many thanks, Liselotte Hartmann", "name"),
    ("My grandmother's neighbour, Ewa Zielinska, pickled everything.", "name"),
    ("Jerome Whitfield and I argued about the salt.", "name"),
    ("The judges, among them Caroline Ashworth, tasted twice.", "name"),
    ("You could hear Mateus Carvalho singing in the pantry.", "name"),
    ("A gift from Yolanda Ibarra, to be eaten cold.", "name"),
]

NOTHING = """Bake at 375 degrees for 25 minutes and turn the tin once.
2 1/2 cups Bramley apples, peeled
Model TX-4471-09 whips cream in 3 minutes.
Lot 20391-44 was recalled in 2019.
My aunt Clara never liked raisins.
Bring 300 g Roquefort and 12 figs.
The parcel has order number 4400918273.
ISBN 978-0-306-40615-7 is out of print.
Serve with Worcestershire Sauce or Tabasco.
Quick Lemon Chicken Soup
Store at 4 C for 3-5 days.
Between 1998 and 2004 the mill stood empty.
Scones with Devon Cream and Strawberry Jam
Calories 320, Fat 12g, Protein 9g
It was 8:30 when the bread came out.
Ingredients and Method
Use 00 flour, 500 g, and 325 ml water.
Error 503, please come back.
We drove along the coast to Cornwall in June.
Nora loves it with honey.
Fold 1/2 the egg white in at a time, then the rest.
1 x 23 cm springform tin
Mix 20 ml vinegar with 980 ml water.
Privacy Notice | Imprint | Contact
Clean the Stainless Steel sink with a soft cloth.""".split("\n")
