"""Terms of the URL filter, with plurals and usual variants."""

# A term that rejects by itself.
STRICT_TERMS = """
anal analsex bangbros bbw bdsm beastiality bestiality blowjob blowjobs boobs brazzers bukkake camgirl camgirls camsex
camshow camshows camwhore camwhores chatroulette chaturbate clit clits cocksucker creampie creampies cumshot
cumshots cunt cunts cybersex deepthroat dildo dildos doujin doujinshi ejaculation erotic erotica escort escorts
escortservice fetish fetishes footfetish fuck fucked fucker fucking fucks futanari gangbang gangbangs gloryhole handjob
handjobs hardcoresex hentai hooker hookers horny jizz lesbiansex livejasmin livesex masturbate masturbating milf milfs
nsfw nudism nudist nudists nympho nymphos onlyfans orgies orgy pedo porn porno pornhub pornography pornos
pornstar pornstars pornvideo pornvideos porns prostitute prostitutes pussies pussy redtube rimjob sexcam sexcams sexchat
sexdating sexshop sextape sextapes sextoy sextoys sexvideo sexvideos shemale shemales slut sluts softcore striptease
stripper strippers swinger swingers threesome threesomes titties tranny trannies upskirt upskirts
voyeur voyeurs webcamsex whore whores xhamster xnxx xvideos xxx xxxvideo xxxvideos youporn

baccarat betfair bookie bookies casino casinos freebet freebets freespins jackpots keno onlinecasino
onlinecasinos onlinepoker pokie pokies slotmachine slotmachines slotsonline sportsbet sportsbetting sportsbook
sportsbooks videopoker videoslots

acomplia cialis clenbuterol dianabol
kamagra levitra
viagra vicodine

crackz keygen keygens nulled serialz torrentz warez warezsite paydayloan paydayloans
""".split()

# A term that needs another beside it.
SOFT_TERMS = """
nudes pegging tits topless vibrator vibrators craps gambling roulette wagering spammer spammers

adderall alprazolam ambien ativan carisoprodol clonazepam diazepam fioricet hydrocodone klonopin lorazepam lunesta
modafinil oxycodone oxycontin percocet phentermine propecia provigil ritalin sildenafil tadalafil tramadol valium
vardenafil vicodin xanax xenical zolpidem

cum adult adults amateur amateurs babe babes bikini bikinis cam cams dating flirt flirting girl girls hot hottest hookup
hookups kinky kiss lesbian lesbians lingerie massage massages mature naked nude nudity panties sensual sex sexes sexier
sexiest sexual sexually sexy singles strip teen teens webcam webcams x

bet bets betting bettor bettors bingo blackjack bonus bonuses chip chips dice gamble gambled gambler gambles gaming
jackpot lotteries lottery lotto odds poker raffle raffles slot slots spin spins stake stakes sweepstake sweepstakes
tipster tipsters wager wagers win winner winners winning wins

cheap cheaper cheapest diet diets discount discounts drug drugs drugstore generic generics herbal med meds medication
medications medicines pharma pharmacies pharmacy pill pills prescription prescriptions rx slim slimming steroid steroids
supplement supplements tablet tablets weightloss

advance bitcoin bitcoins borrow cash cashback cheque credit credits crypto cryptos debt debts deal deals dollar dollars
earn earning earnings forex free freebie freebies gift gifts giveaway giveaways income instant invest investing lender
lenders lending loan loans luxury millionaire millionaires money mortgage mortgages payday prize prizes profit profits
promo promos promotion promotions quick refinance replica replicas reward rewards rich rolex voucher vouchers wealth

ad adclick adclicks ads adserver adservers advert adverts advertise advertisement advertisements advertising adware
affiliate affiliates banner banners beacon beacons bulk click clicks clickbait doubleclick farm farms impression
impressions popunder popunders popup popups spam spams sponsor sponsored sponsors track tracked tracker trackers
tracking tracks traffic

trojan activator activators crack download downloads hack hacked hacks keys leech leeched pirate pirated pirates proxies
proxy rapidshare serial serials torrent torrents unlock unlocked
""".split()
