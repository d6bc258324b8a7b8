"""A small labelled table of urls, made up for training the url filter: host and path of each."""

BLOCKED = """
royal-casino-spins.com/bonus/free-spins
casino-jackpot-club.net/play/slots
mega-slots-casino.org/signup/bonus
lucky-poker-room.com/casino/bonus
pokerbonus24.net/free/chips
bet-now-odds.com/betting/live
sportsbetting-tips.net/odds/today
best-betting-bonus.com/free-bets
slotmachine-free.org/games/casino
online-roulette-wins.com/casino/roulette
casino-blackjack-vip.net/promo
bingo-bonus-casino.com/register
adult-cams-live.com/xxx/girls
free-xxx-videos.net/adult/watch
sexy-singles-chat.com/adult/dating
hot-adult-dating.net/xxx/signup
xxx-tube-porn.org/videos/adult
porn-pics-free.com/gallery/xxx
camgirls-porn.net/live/adult
adult-escorts-city.com/escorts/list
hookup-tonight-sex.net/join
nude-celebs-xxx.com/photos/porn
cheap-viagra-pills.com/buy/viagra
buy-cialis-online.net/pharmacy/order
discount-pharmacy-pills.org/buy/pills
no-prescription-pharmacy.com/viagra/cheap
weight-loss-miracle-pills.net/order-now
cheap-meds-pharmacy.com/buy/tramadol
steroids-buy-cheap.net/order/pills
diet-pills-miracle.com/buy-now
torrent-movies-free.net/download/torrent
warez-crack-keygen.com/download/crack
full-version-cracks.net/keygen/download
free-serial-keygen.org/crack/office
pirate-torrents-hd.com/torrent/movies
mp3-free-torrent.net/download/warez
game-cracks-warez.com/torrent/games
nulled-scripts-crack.net/download
replica-watches-cheap.com/buy/rolex
cheap-replica-handbags.net/buy/cheap
fake-designer-outlet.com/cheap/replica
cheap-jerseys-outlet.net/buy-now
payday-loans-fast.com/cash/loan
quick-cash-loans-now.net/apply/payday
bad-credit-loans-cash.com/payday/apply
instant-payday-cash.org/loan/now
get-rich-quick-crypto.com/profit/signup
bitcoin-doubler-profit.net/free/bitcoin
crypto-giveaway-free.com/claim/bitcoin
forex-robot-profit.net/buy-now
make-money-fast-online.com/earn/cash
earn-cash-surveys.net/signup/free
free-gift-cards-win.com/claim/prize
winner-prize-claim.net/free/iphone
iphone-giveaway-winner.com/claim/now
click-here-win-prize.net/promo/claim
seo-backlinks-cheap.com/buy/links
buy-backlinks-traffic.net/order/links
cheap-followers-likes.com/buy/followers
bulk-email-traffic.net/buy/leads
popunder-ads-traffic.com/ads/click
adserver-click-track.net/banner/click
ads-banner-popup.com/track/click
tracker-pixel-ads.net/pixel/track
account-verify-login.com/secure/verify-login
paypal-login-verify.net/account/secure
bank-secure-update.com/login/verify
verify-account-alert.net/signin/update
apple-id-unlock-verify.com/login/account
free-essay-buy-cheap.com/order/essay
cheap-essay-writing.net/buy/essay
buy-dissertation-now.com/order/cheap
"""

ALLOWED = """
docs.library.org/manual/install
docs.compiler.dev/reference/types
www.university.edu/research/papers
physics.university.edu/courses/mechanics
www.museum.org/collections/paintings
archive.museum.org/catalogue/maps
www.newspaper.com/world/politics
www.newspaper.com/science/climate
blog.gardening.net/roses/pruning
blog.travelnotes.com/norway/fjords
www.cooking.com/recipes/bread
recipes.kitchen.net/soups/lentil
en.encyclopedia.org/wiki/photosynthesis
de.encyclopedia.org/wiki/geschichte
fr.encyclopedia.org/wiki/histoire
es.encyclopedia.org/wiki/historia
www.weather.gov/forecast/north
www.parliament.gov/bills/education
data.statistics.gov/population/regions
www.city.gov/services/water
www.hospital.org/health/vaccines
health.institute.org/articles/sleep
journals.science.org/biology/cells
journals.science.org/articles/chemistry
www.publisher.com/books/novels
books.publisher.com/authors/poetry
forum.photography.net/threads/lenses
forum.cycling.net/threads/brakes
www.railway.com/timetable/stations
www.airport.com/flights/arrivals
maps.atlas.org/europe/rivers
www.atlas.org/countries/geography
www.orchestra.org/concerts/season
music.theory.net/lessons/harmony
www.theatre.com/plays/programme
film.review.com/articles/cinema
www.school.edu/teachers/lessons
library.school.edu/catalogue/children
www.farm.org/seeds/wheat
wildlife.trust.org/birds/migration
www.astronomy.org/stars/planets
telescope.observatory.edu/images/galaxies
news.technology.com/articles/processors
www.engineering.net/bridges/design
code.repository.dev/project/readme
code.repository.dev/issues/history
help.software.com/guides/printing
support.software.com/articles/settings
www.history.org/medieval/castles
genealogy.history.org/records/parish
language.dictionary.com/words/etymology
www.dictionary.com/grammar/verbs
sports.newspaper.com/athletics/results
www.marathon.org/results/history
www.sailing.org/races/regatta
trails.hiking.net/mountains/huts
www.economy.com/analysis/trade
finance.newspaper.com/markets/report
law.university.edu/cases/contracts
www.court.gov/judgments/archive
www.charity.org/projects/schools
volunteer.charity.org/stories/community
philosophy.journal.org/essays/ethics
www.mathematics.edu/lectures/algebra
blog.knitting.net/patterns/scarf
www.woodwork.net/tools/joinery
nursery.garden.com/trees/apple
www.radio.org/programmes/interviews
podcast.radio.org/episodes/science
www.gallery.com/exhibitions/sculpture
letters.archive.org/correspondence/index
www.village.org/events/market
www.bakery.com/en/contact
www.bakery.com/de/kontakt.html
blog.rowing.net/en/17
blog.rowing.net/fr/204
m.furniture.com/en/chairs
m.furniture.com/es/sillas.html
www.dentist.net/en/opening-hours
www.hotel.com/fr/chambres
www.hotel.com/en/rooms/31
blog.teacher.net/en/412.html
blog.teacher.net/de/88
shop.stationery.com/en/paper
www.bookshop.net/es/libros
m.weather.net/en/today
www.choir.net/en/about
www.choir.net/fr/accueil.html
news.valley.com/en/2019/harvest
news.valley.com/de/2020
www.plumber.com/en/services
blog.painter.net/es/77.html
www.insurance.com/en/claims/form
www.tennis.net/en/club/members
m.tennis.net/en/5
www.hostel.net/de/zimmer
support.printer.com/en/drivers
www.carpets.com/fr/tapis
www.theater.net/en/tickets
blog.nurse.com/en/903
www.vineyard.net/es/vinos.html
www.vineyard.net/en/visit
home.orchard.com/en/
www.ferry.net/de/fahrplan
www.ferry.net/en/fares
m.bicycle.com/fr/12.html
www.potter.net/en/studio
"""
