"""Lines written for the test of page furniture, none of them taken from a table."""

FURNITURE = """Sign in to post a comment
Terms and Conditions
Related Articles
Share on Facebook
Skip navigation
Follow us on Instagram
Download our app
Create an account to save your favourites
Already a member? Log in here
We use cookies to personalise content and ads
Manage your consent preferences
Read more reviews
Write a review
Report this comment
Show all 14 replies
Sort comments by newest
Unsubscribe at any time
Get the newsletter
Sign up with your email address
By subscribing you agree to our privacy policy
Sponsored content
This post contains affiliate links
All content copyright of its respective owners
Powered by WordPress
Advertise with us
Site map
Help centre
Customer support
Find us on YouTube
Tweet this
Pin this post
Email this page to a friend
Print this article
View the photo gallery
More stories from this author
Latest news
Most shared this month
Editor recommended
Popular tags
Browse the archives
Next article
Older posts
Loading more comments
Accept cookies and continue
Privacy and legal notice
Contact the editorial team
Login or register to vote
Rated 4.5 by 212 users
Was this page helpful? Send feedback
Join our community forum""".split("\n")

BODY = """Whisk the eggs with the sugar until the mixture is pale.
Set the oven to 180 degrees and grease a deep tin.
My grandmother made this every Sunday after church.
2 tablespoons of melted butter
A pinch of nutmeg
Leave the dough in a warm spot until it has doubled.
Serve with boiled potatoes and a green salad.
half a lemon, juiced
3 cloves garlic, crushed
Rinse the cloth in cold water before you wash it.
Mix one part vinegar with four parts warm water.
Do not use bleach on wool or silk.
Scrub the grout with a soft brush and baking soda.
Let it dry overnight before you walk on the floor.
The sauce keeps for a week in the fridge.
fresh parsley, to serve
Chop the onion finely and fry it in oil until soft.
Salt and pepper
You can freeze the soup in small portions.
The crust should be golden and the filling just set.
400 g plain flour
Knead for ten minutes by hand, or five with a mixer.
Wipe the windows with newspaper for a streak free finish.
Test the cleaner on a hidden patch first.
We ate it on the terrace while the sun went down.
Share the pie between four plates and pour the custard over it.
Follow the grain of the wood when you sand the board.
Print out of the mould comes easily if you dip it in hot water.
Sign of a good loaf: it sounds hollow when you tap it.
The top of the cake will crack a little, which is fine.
Stir in the cream and continue to cook for two minutes.
Close the lid and let the rice steam.
Save the cooking water, because the starch thickens the sauce.
Link the sausages and hang them in a cool room.
vegetable oil for frying
Cover the bowl with a damp towel
Drain well.
one large aubergine
Roast until the edges char and the middle is soft.
Store in a jar with a tight lid.
Blend until smooth.
The stain came out after the second wash.
Accept that the first pancake always fails.
250 ml whole milk
Use a sharp knife, or the tomatoes will tear.
Turn the chicken halfway through.
Soak the beans overnight in plenty of water.
Season to taste and serve at once.
I like it best with rye bread.
1 small red chilli, deseeded""".split("\n")
